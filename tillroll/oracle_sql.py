"""DuckDB oracle SQL for every registered query (independent of Spark).

The driver tables are pre-registered as views.  The restatement scenario,
the calendar and the surrogate ids are written out again in plain SQL, so a
match checks the Spark plans against an independent statement of the same
semantics.  Column names and types equal the Spark outputs.
"""

from __future__ import annotations

from .oracle_hash import surrogate_key_sql, wide_key_sql


def _key(expr: str) -> str:
    """Id of a member in a warehouse: 63 bits."""
    return wide_key_sql(expr)


def _date_id(expr: str) -> str:
    return f"CAST(year({expr}) * 10000 + month({expr}) * 100 + day({expr}) AS BIGINT)"


# Fixed values (equal to catalog / retail_model): scenario cut weeks, load
# times, example retailer list, delivery folders and the first week.
_A_UNTIL = "DATE '1999-01-03'"
_B_FROM = "DATE '1998-07-05'"
_TS_A = "'2024-01-07 09:00:00'"
_TS_B = "'2024-01-14 09:00:00'"
_FIRST_WEEK = "DATE '1995-01-08'"

_LI = """li AS (
  SELECT l_partkey, l_suppkey,
         CAST(CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS DATE) AS wk,
         l_quantity, CAST(l_extendedprice AS DECIMAL(13,2)) AS price, l_discount, l_returnflag
  FROM lineitem)"""

_GROSS = """gross AS (
  SELECT CAST(g.l_partkey AS BIGINT) AS "SKU", s.s_name AS "Retailer", g.wk AS "Week Ending",
         CAST(g.units AS INTEGER) AS "Units", CAST(g.sales AS DECIMAL(13,2)) AS "Sales"
  FROM (SELECT wk, l_partkey, l_suppkey, SUM(l_quantity) AS units, SUM(price) AS sales
        FROM li GROUP BY wk, l_partkey, l_suppkey) g
  LEFT JOIN supplier s ON s.s_suppkey = g.l_suppkey)"""

_NET = """net AS (
  SELECT CAST(g.l_partkey AS BIGINT) AS "SKU", s.s_name AS "Retailer", g.wk AS "Week Ending",
         CAST(g.units AS INTEGER) AS "Units", CAST(g.sales AS DECIMAL(13,2)) AS "Sales"
  FROM (SELECT wk, l_partkey, l_suppkey, SUM(l_quantity) AS units,
               SUM(price * (1 - CAST(l_discount AS DECIMAL(13,2)))) AS sales
        FROM li WHERE l_returnflag IS DISTINCT FROM 'R' GROUP BY wk, l_partkey, l_suppkey) g
  LEFT JOIN supplier s ON s.s_suppkey = g.l_suppkey)"""

_MAPPER = """mapper AS (
  SELECT CAST(x.l_partkey AS BIGINT) AS "SKU", s.s_name AS "Retailer",
         p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS "Description", p.p_type AS "ProductType"
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x
  JOIN part p ON p.p_partkey = x.l_partkey
  JOIN supplier s ON s.s_suppkey = x.l_suppkey)"""

_BATCHES = f"""batch_a AS (SELECT * FROM gross WHERE "Week Ending" < {_A_UNTIL}),
batch_b AS (SELECT * FROM net WHERE "Week Ending" >= {_B_FROM})"""


def _enriched(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT e."Week Ending" AS "Date", e."SKU", e."Retailer", e."Units" AS "UnitsSold", e."Sales" AS "SalesAmount",
         'MAT' AS "DataSource", m."Description", m."ProductType"
  FROM {src} e LEFT JOIN mapper m ON m."SKU" = e."SKU" AND m."Retailer" = e."Retailer")"""


# Ids are computed once per distinct name, then joined back by name.
_PID = """pid AS (SELECT n, {k} AS id FROM (SELECT DISTINCT "Description" AS n FROM mapper WHERE "Description" IS NOT NULL))"""
_RID = """rid AS (SELECT n, {k} AS id FROM (SELECT DISTINCT s_name AS n FROM supplier WHERE s_name IS NOT NULL))"""


def _ids() -> str:
    return _PID.format(k=_key("n")) + ",\n" + _RID.format(k=_key("n"))


def _facts(enriched: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {_date_id('e."Date"')} AS "DateId", p.id AS "ProductId", r.id AS "RetailerId",
         e."DataSource", e."SKU", e."UnitsSold", e."SalesAmount"
  FROM {enriched} e
  LEFT JOIN pid p ON p.n = e."Description"
  LEFT JOIN rid r ON r.n = e."Retailer")"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_SCENARIO = _with(
    _LI, _GROSS, _NET, _MAPPER, _BATCHES,
    _enriched("batch_a", "ea"), _enriched("batch_b", "eb"), _ids(),
    _facts("ea", "fa"), _facts("eb", "fb"),
)

_CHANGED = """(a."DataSource" IS DISTINCT FROM b."DataSource" OR a."SKU" IS DISTINCT FROM b."SKU"
  OR a."UnitsSold" IS DISTINCT FROM b."UnitsSold" OR a."SalesAmount" IS DISTINCT FROM b."SalesAmount")"""

_KEY_JOIN = """a."DateId" = b."DateId" AND a."ProductId" = b."ProductId" AND a."RetailerId" = b."RetailerId\""""

# Fact after A then B: B wins on its keys, unchanged rows keep their audit.
_AFTER_AB = f"""ab AS (
  SELECT COALESCE(b."DateId", a."DateId") AS "DateId", COALESCE(b."ProductId", a."ProductId") AS "ProductId",
         COALESCE(b."RetailerId", a."RetailerId") AS "RetailerId",
         CASE WHEN b."DateId" IS NULL THEN a."DataSource" ELSE b."DataSource" END AS "DataSource",
         CASE WHEN b."DateId" IS NULL THEN a."SKU" ELSE b."SKU" END AS "SKU",
         CASE WHEN b."DateId" IS NULL THEN a."UnitsSold" ELSE b."UnitsSold" END AS "UnitsSold",
         CASE WHEN b."DateId" IS NULL THEN a."SalesAmount" ELSE b."SalesAmount" END AS "SalesAmount",
         CASE WHEN a."DateId" IS NULL THEN {_TS_B} ELSE {_TS_A} END AS "CreatedTime",
         CAST(CASE WHEN a."DateId" IS NULL THEN 2 ELSE 1 END AS INTEGER) AS "CreatedByBatchId",
         CASE WHEN a."DateId" IS NOT NULL AND b."DateId" IS NOT NULL AND {_CHANGED} THEN {_TS_B} END AS "UpdatedTime",
         CAST(CASE WHEN a."DateId" IS NOT NULL AND b."DateId" IS NOT NULL AND {_CHANGED} THEN 2 END AS INTEGER) AS "UpdatedByBatchId"
  FROM fa a FULL OUTER JOIN fb b ON {_KEY_JOIN})"""

_FACT_COLS = '"DateId", "ProductId", "RetailerId", "DataSource", "SKU", "UnitsSold", "SalesAmount"'
_AUDIT_COLS = '"CreatedTime", "CreatedByBatchId", "UpdatedTime", "UpdatedByBatchId"'

# Products / retailers after A then B (insert-only; first load kept).
_DIMS_AB = f"""prod AS (
  SELECT p.id AS "ProductId", c."Description" AS "ProductName", c."ProductType",
         CASE WHEN c.in_a THEN {_TS_A} ELSE {_TS_B} END AS "CreatedTime",
         CAST(CASE WHEN c.in_a THEN 1 ELSE 2 END AS INTEGER) AS "CreatedByBatchId"
  FROM (SELECT "Description", "ProductType", bool_or(src = 'a') AS in_a
        FROM (SELECT "Description", "ProductType", 'a' AS src FROM ea
              UNION ALL SELECT "Description", "ProductType", 'b' FROM eb)
        GROUP BY "Description", "ProductType") c
  JOIN pid p ON p.n = c."Description"),
ret AS (
  SELECT r.id AS "RetailerId", c."Retailer" AS "RetailerName",
         CASE WHEN c.in_a THEN {_TS_A} ELSE {_TS_B} END AS "CreatedTime",
         CAST(CASE WHEN c.in_a THEN 1 ELSE 2 END AS INTEGER) AS "CreatedByBatchId"
  FROM (SELECT "Retailer", bool_or(src = 'a') AS in_a
        FROM (SELECT "Retailer", 'a' AS src FROM ea UNION ALL SELECT "Retailer", 'b' FROM eb)
        GROUP BY "Retailer") c
  JOIN rid r ON r.n = c."Retailer")"""

_FULL = _with(_LI, _GROSS, _MAPPER, _enriched("gross", "ef"), _ids())

_CAL_BOUNDS = """bounds AS (
  SELECT make_date(CAST(min(year(l_shipdate)) AS INTEGER), 1, 1) AS lo,
         make_date(CAST(max(year(l_shipdate)) AS INTEGER) + 1, 1, 1) AS hi FROM lineitem)"""


def _date_cols(d: str) -> str:
    return f"""{_date_id(d)} AS "DateId", {d} AS "Date",
  CAST(CAST(date_trunc('week', {d}) AS DATE) + 6 AS DATE) AS "WeekEnding",
  CAST(date_trunc('week', {d}) AS DATE) AS "WeekCommencing",
  dayname({d}) AS "DayOfWeekName", CAST(isodow({d}) AS INTEGER) AS "DayOfWeekNumber",
  CAST(day({d}) AS INTEGER) AS "DayOfMonth", CAST(dayofyear({d}) AS INTEGER) AS "DayOfYear",
  monthname({d}) AS "MonthName", CAST(month({d}) AS INTEGER) AS "MonthNumber",
  CAST(quarter({d}) AS INTEGER) AS "QuarterNumber", 'Q' || CAST(quarter({d}) AS VARCHAR) AS "QuarterPresentation",
  CAST(year({d}) AS INTEGER) AS "Year\""""


_CALENDAR = f"""{_CAL_BOUNDS},
cal AS (SELECT CAST(d AS DATE) AS d FROM bounds, range(bounds.lo, bounds.hi, INTERVAL 1 DAY) t(d))"""


def _gate_rows(table: str, rows: list[tuple[str, str, str, str]]) -> str:
    """Report rows (seq, check, columns, violations, message) from (check, columns, violations-expr, message)."""
    sel = []
    for i, (check, cols, viol, msg) in enumerate(rows, start=1):
        sel.append(
            f"SELECT CAST({i} AS INTEGER) AS seq, '{check}' AS \"check\", '{cols}' AS columns, "
            f"CAST(({viol}) AS BIGINT) AS violations, CASE WHEN ({viol}) > 0 THEN '{msg}' END AS message FROM {table}"
        )
    return "\nUNION ALL\n".join(sel)


ORACLE: dict[str, str] = {
    "weekly_extract": _with(_LI, _GROSS) + "SELECT * FROM gross",
    "scan_extract": _with(_LI, _GROSS) + "SELECT * FROM gross",
    "export_extract": _with(_LI, _GROSS)
    + """SELECT 'week=' || strftime("Week Ending", '%Y-%m-%d') AS folder,
       CAST("SKU" AS VARCHAR) || ',' || "Retailer" || ',' || strftime("Week Ending", '%d/%m/%Y') || ','
       || CAST("Units" AS VARCHAR) || ',' || CAST("Sales" AS VARCHAR) AS line
FROM gross""",
    "read_or_empty": _SCENARIO + "," + _DIMS_AB + '\nSELECT "ProductId", "ProductName", "ProductType" FROM prod',
    "table_replace": _SCENARIO
    + f"""SELECT {_FACT_COLS} FROM fa WHERE "DateId" NOT IN (SELECT DISTINCT "DateId" FROM fb)
UNION ALL SELECT {_FACT_COLS} FROM fb""",
    "publish_lookup": _with(_MAPPER) + "SELECT *, 'edw' AS copy FROM mapper UNION ALL SELECT *, 'raw' AS copy FROM mapper",
    "conform_extract": _with(_LI, _GROSS)
    + """SELECT "Week Ending" AS "Date", "SKU", "Retailer", "Units" AS "UnitsSold", "Sales" AS "SalesAmount",
       'MAT' AS "DataSource" FROM gross""",
    "stamp_audit": _FULL
    + f"""SELECT p.id AS "ProductId", c."Description" AS "ProductName", c."ProductType",
       {_TS_A} AS "CreatedTime", CAST(NULL AS INTEGER) AS "CreatedByBatchId",
       CAST(NULL AS VARCHAR) AS "UpdatedTime", CAST(NULL AS INTEGER) AS "UpdatedByBatchId"
FROM (SELECT DISTINCT "Description", "ProductType" FROM ef) c
LEFT JOIN pid p ON p.n = c."Description\"""",
    "filter_retailers": _with(_MAPPER)
    + """SELECT * FROM mapper WHERE "Retailer" IN ('Supplier#000000001', 'Supplier#000000002', 'Supplier#000000003')""",
    "changed_rows": _SCENARIO
    + f"""SELECT a."DateId", a."ProductId", a."RetailerId",
       a."DataSource" AS "OldDataSource", a."SKU" AS "OldSKU", a."UnitsSold" AS "OldUnitsSold", a."SalesAmount" AS "OldSalesAmount",
       b."DataSource" AS "NewDataSource", b."SKU" AS "NewSKU", b."UnitsSold" AS "NewUnitsSold", b."SalesAmount" AS "NewSalesAmount"
FROM fa a JOIN fb b ON {_KEY_JOIN}
WHERE {_CHANGED}""",
    "week_endings": _with(_CALENDAR) + f"""SELECT {_date_id('d')} AS "DateId", d AS "Date" FROM cal WHERE isodow(d) = 7""",
    "enrich_extract": _FULL + "SELECT * FROM ef",
    "resolve_keys": _FULL + "," + _facts("ef", "ff") + "\nSELECT * FROM ff",
    "new_products": _FULL
    + f""", first_week AS (SELECT DISTINCT "Description" FROM ef WHERE "Date" = {_FIRST_WEEK})
SELECT p.id AS "ProductId", c."Description" AS "ProductName", c."ProductType"
FROM (SELECT DISTINCT "Description", "ProductType" FROM ef) c
LEFT JOIN pid p ON p.n = c."Description"
WHERE c."Description" IS NULL OR c."Description" NOT IN (SELECT "Description" FROM first_week WHERE "Description" IS NOT NULL)""",
    "new_retailers": _FULL
    + f""", first_week AS (SELECT DISTINCT "Retailer" FROM ef WHERE "Date" = {_FIRST_WEEK})
SELECT r.id AS "RetailerId", c."Retailer" AS "RetailerName"
FROM (SELECT DISTINCT "Retailer" FROM ef) c
LEFT JOIN rid r ON r.n = c."Retailer"
WHERE c."Retailer" IS NULL OR c."Retailer" NOT IN (SELECT "Retailer" FROM first_week WHERE "Retailer" IS NOT NULL)""",
    "fact_inserts": _SCENARIO
    + f"""SELECT {_FACT_COLS} FROM fb b
WHERE NOT EXISTS (SELECT 1 FROM fa a WHERE {_KEY_JOIN})""",
    "fact_keeps": _SCENARIO
    + f"""SELECT {_FACT_COLS} FROM fa a
WHERE a."DateId" IN (SELECT DISTINCT "DateId" FROM fb)
  AND NOT EXISTS (SELECT 1 FROM fb b WHERE {_KEY_JOIN})""",
    "fact_updates": _SCENARIO
    + f"""SELECT b."DateId", b."ProductId", b."RetailerId", b."DataSource", b."SKU", b."UnitsSold", b."SalesAmount",
       {_TS_A} AS "CreatedTime", CAST(1 AS INTEGER) AS "CreatedByBatchId",
       {_TS_B} AS "UpdatedTime", CAST(2 AS INTEGER) AS "UpdatedByBatchId"
FROM fa a JOIN fb b ON {_KEY_JOIN}
WHERE {_CHANGED}""",
    "view_sales": _SCENARIO + "," + _AFTER_AB + "," + _DIMS_AB
    + """
SELECT CAST(make_date(CAST(f."DateId" / 10000 AS INTEGER), CAST((f."DateId" / 100) % 100 AS INTEGER), CAST(f."DateId" % 100 AS INTEGER)) AS DATE) AS "Date",
       p."ProductName", r."RetailerName", f."DataSource", f."SKU", f."UnitsSold", f."SalesAmount"
FROM ab f JOIN prod p ON p."ProductId" = f."ProductId" JOIN ret r ON r."RetailerId" = f."RetailerId\"""",
    "distinct_products": _FULL + """SELECT DISTINCT "Description" AS "ProductName", "ProductType" FROM ef""",
    "distinct_retailers": _with(_LI, _GROSS) + """SELECT DISTINCT "Retailer" AS "RetailerName" FROM gross""",
    "max_or_zero": _with(_LI, _GROSS)
    + """SELECT CASE WHEN count(*) = 0 THEN 0 ELSE max("Units") END AS max_value FROM gross""",
    "gate_unique": "WITH k AS (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT p_name FROM part)) AS d FROM part)\n"
    + _gate_rows("k", [("unique", "p_name", "n - d", "ETL: Part Table - p_name must NOT have duplicates")]),
    "gate_unique_key": "WITH k AS (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS d FROM lineitem)\n"
    + _gate_rows("k", [("unique", "l_orderkey,l_linenumber", "n - d", "ETL: Lineitem Table - List(l_orderkey, l_linenumber) must NOT have duplicates")]),
    "gate_not_null": _FULL
    + _gate_rows("ef", [("not_null", "Description", 'count(*) FILTER (WHERE "Description" IS NULL)', "ETL: Enriched Extract - Description must NOT have null values")]),
    "gate_report": _SCENARIO
    + f""", merged AS (
  SELECT * FROM fb
  UNION ALL
  SELECT {_FACT_COLS} FROM fa a WHERE a."DateId" IN (SELECT DISTINCT "DateId" FROM fb)
    AND NOT EXISTS (SELECT 1 FROM fb b WHERE {_KEY_JOIN})),
k AS (SELECT count(*) AS n,
             count(*) FILTER (WHERE "DateId" IS NULL) AS n_date, count(*) FILTER (WHERE "ProductId" IS NULL) AS n_prod,
             count(*) FILTER (WHERE "RetailerId" IS NULL) AS n_ret,
             (SELECT count(*) FROM (SELECT DISTINCT "DateId", "ProductId", "RetailerId" FROM merged)) AS d
      FROM merged)
"""
    + _gate_rows(
        "k",
        [
            ("not_null", "DateId", "n_date", "ETL: Sales Fact Table - DateId must NOT have null values"),
            ("not_null", "ProductId", "n_prod", "ETL: Sales Fact Table - ProductId must NOT have null values"),
            ("not_null", "RetailerId", "n_ret", "ETL: Sales Fact Table - RetailerId must NOT have null values"),
            ("unique", "DateId,ProductId,RetailerId", "n - d", "ETL: Sales Fact Table - List(DateId, ProductId, RetailerId) must NOT have duplicates"),
        ],
    ),
    "merge_dim": _SCENARIO
    + """SELECT p.id AS "ProductId", c."Description" AS "ProductName", c."ProductType",
       CAST(CASE WHEN c.in_a THEN 1 ELSE 2 END AS INTEGER) AS "CreatedByBatchId"
FROM (SELECT "Description", "ProductType", bool_or(src = 'a') AS in_a
      FROM (SELECT "Description", "ProductType", 'a' AS src FROM ea
            UNION ALL SELECT "Description", "ProductType", 'b' FROM eb)
      GROUP BY "Description", "ProductType") c
JOIN pid p ON p.n = c."Description\"""",
    "table_diff": _SCENARIO + "," + _AFTER_AB
    + f""", tagged AS (SELECT {_FACT_COLS}, 1 AS w FROM fa UNION ALL SELECT {_FACT_COLS}, -1 AS w FROM ab),
counted AS (SELECT {_FACT_COLS}, sum(w) AS net FROM tagged GROUP BY ALL)
SELECT {_FACT_COLS}, CASE WHEN net > 0 THEN 'left_only' ELSE 'right_only' END AS side, CAST(abs(net) AS BIGINT) AS copies
FROM counted WHERE net <> 0""",
    "surrogate_key": _with(_MAPPER)
    + f"""SELECT 'product' AS "Kind", n AS "Name", {surrogate_key_sql('n')} AS "Id" FROM (SELECT DISTINCT "Description" AS n FROM mapper)
UNION ALL
SELECT 'retailer' AS "Kind", n AS "Name", {surrogate_key_sql('n')} AS "Id" FROM (SELECT DISTINCT "Retailer" AS n FROM mapper)""",
    "date_parts": "WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)\nSELECT "
    + _date_cols("d") + " FROM days",
    "date_range": """WITH b AS (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem)
SELECT CAST(d AS DATE) AS "Date" FROM b, range(b.lo, b.hi, INTERVAL 1 DAY) t(d)""",
    "line_amount": """SELECT CAST(l.l_partkey AS BIGINT) AS "SKU",
       strftime(CAST(date_trunc('week', l.l_shipdate) AS DATE) + 6, '%d/%m/%Y') AS "Week Ending",
       CAST(l.l_quantity AS INTEGER) AS "Units",
       CAST(round(CAST(p.p_retailprice AS DECIMAL(24,10)) * CAST(CAST(l.l_quantity AS INTEGER) AS DECIMAL(10,0)), 2) AS DECIMAL(13,2)) AS "Sales"
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey""",
    "date_dimension": _with(_CALENDAR) + "SELECT " + _date_cols("d") + " FROM cal",
    "load_product": _SCENARIO + "," + _DIMS_AB + "\nSELECT * FROM prod",
    "load_retailer": _SCENARIO + "," + _DIMS_AB + "\nSELECT * FROM ret",
    "upsert_sales": _SCENARIO + "," + _AFTER_AB + f"\nSELECT {_FACT_COLS}, {_AUDIT_COLS} FROM ab",
    "upsert_replay": _SCENARIO + "," + _AFTER_AB + f"\nSELECT {_FACT_COLS}, {_AUDIT_COLS} FROM ab",
    "view_retailer": _SCENARIO + "," + _DIMS_AB + '\nSELECT "RetailerId", "RetailerName" FROM ret',
    "view_product": _SCENARIO + "," + _DIMS_AB + '\nSELECT "ProductId", "ProductName", "ProductType" FROM prod',
    "register_batches": _with(_LI, _GROSS)
    + """SELECT CAST(row_number() OVER (ORDER BY wk) AS BIGINT) AS "BatchId", 'MAT' AS "DataSource",
       'week=' || strftime(wk, '%Y-%m-%d') AS "Folder"
FROM (SELECT DISTINCT "Week Ending" AS wk FROM gross UNION SELECT DATE '2099-01-04')""",
    "backfill_weeks": _SCENARIO + "," + _AFTER_AB
    + f"""
SELECT {_FACT_COLS}, {_TS_A} AS "CreatedTime", "CreatedByBatchId",
       CASE WHEN "UpdatedTime" IS NOT NULL THEN {_TS_A} END AS "UpdatedTime", "UpdatedByBatchId" FROM ab""",
    "backfill_replay": _SCENARIO + "," + _AFTER_AB
    + f"""
SELECT {_FACT_COLS}, {_TS_A} AS "CreatedTime", "CreatedByBatchId",
       CASE WHEN "UpdatedTime" IS NOT NULL THEN {_TS_A} END AS "UpdatedTime", "UpdatedByBatchId" FROM ab""",
    "late_delivery": _SCENARIO + "," + _AFTER_AB
    + f"""
SELECT {_FACT_COLS}, concat_ws(',', CASE WHEN ("DateId", "ProductId", "RetailerId") IN (SELECT ("DateId", "ProductId", "RetailerId") FROM fa) THEN '1998-12-27' END,
       CASE WHEN ("DateId", "ProductId", "RetailerId") IN (SELECT ("DateId", "ProductId", "RetailerId") FROM fb) THEN '2001-11-04' END) AS "Dates" FROM ab""",
    "stream_deliveries": _SCENARIO + "," + _AFTER_AB + f'\nSELECT {_FACT_COLS}, "CreatedByBatchId", "UpdatedByBatchId" FROM ab',
    "surrogate_key_wide": _with(_MAPPER)
    + f"""SELECT n AS "Name", {_key('n')} AS "Id" FROM (SELECT DISTINCT "Description" AS n FROM mapper)""",
    "parse_dates": """WITH t AS (SELECT DISTINCT strftime(CAST(date_trunc('week', l_shipdate) AS DATE) + 6, '%d/%m/%Y') AS x FROM lineitem)
SELECT x AS "Text", CAST(try_strptime(x, '%d/%m/%Y') AS DATE) AS "Date", CAST(try_strptime(x, '%Y-%m-%d') AS DATE) AS "Other" FROM t""",
    "export_order": _with(_LI, _GROSS)
    + """SELECT 'week=' || strftime("Week Ending", '%Y-%m-%d') AS folder, count(*) AS lines, count(*) AS in_order FROM gross GROUP BY ALL""",
    "line_amount_net": """WITH x AS (
  SELECT l.l_partkey, CAST(l.l_quantity AS INTEGER) AS units,
         CAST(p.p_retailprice AS DECIMAL(13,2)) * (1 - CAST(l.l_discount AS DECIMAL(13,2))) AS price
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey)
SELECT CAST(l_partkey AS BIGINT) AS "SKU", CAST(price AS DECIMAL(16,4)) AS "Price", units AS "Units",
       CAST(round(CAST(price AS DECIMAL(24,10)) * CAST(units AS DECIMAL(10,0)), 2) AS DECIMAL(13,2)) AS "Sales" FROM x""",
    "view_product_names": _SCENARIO + "," + _DIMS_AB + '\nSELECT "ProductName", "ProductType" FROM prod',
    "view_retailer_names": _SCENARIO + "," + _DIMS_AB + '\nSELECT "RetailerName" FROM ret',
}
