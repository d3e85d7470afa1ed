"""Registered queries: one per operator of the warehouse, over the driver tables.

Every query reads the transaction tables under ``sf_dir`` (lineitem, part,
supplier) or tables that Spark derives from them, so its work grows with
the data.  Queries that need a loaded warehouse share one per session and
scale directory (built on first use under the shared scratch folder).

Scenario (see ``sources.retail_model``): delivery A carries gross weekly
figures before 1999-01-03; delivery B restates the weeks from 1998-07-05 net
of returned lines.  A is loaded at ``TS_A`` (batch 1), then B at ``TS_B``
(batch 2); the replay loads B again at ``TS_C``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions.calendar import date_parts, date_range, is_week_end
from .functions.keys import surrogate_key, wide_key
from .functions.money import extract_date_text, line_amount, parse_date, to_money
from .operators import quality as Q
from .operators.batches import register_batches
from .operators.diff import table_diff
from .operators.dimensions import (
    PRODUCT_GATE,
    PRODUCT_TABLE,
    merge_dim,
    new_members,
    product_candidates,
    retailer_candidates,
)
from .operators.fact import (
    SALES_GATE,
    SALES_TABLE,
    changed_rows,
    conform_extract,
    enrich_extract,
    merge_fact,
    resolve_keys,
    touched_date_ids,
)
from .operators.views import view_product, view_retailer, view_sales
from .plans.date_dimension import build_date_dimension, write_date_dimension
from .plans.weekly_load import backfill, run_weekly
from .schemas import FACT_KEY, FACT_VALUES
from .session import scratch_dir, sized_shuffles
from .sources import retail_model as RM
from .sources.extract import delivery_folders, export_extract, read_export_order, read_extract, read_extract_lines
from .sources.tables import Warehouse, publish_lookup, read_or_empty, write_table

# Load times of the example deliveries, the retailer list of the
# filter example, and the folder names the two deliveries are exported to.
TS_A = "2024-01-07 09:00:00"
TS_B = "2024-01-14 09:00:00"
TS_C = "2024-01-21 09:00:00"
EXAMPLE_RETAILERS = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003"]
DELIVERY_A = _dt.date(1998, 12, 27)
DELIVERY_B = _dt.date(2001, 11, 4)
FIRST_WEEK = _dt.date(1995, 1, 8)
EMPTY_DELIVERY = _dt.date(2099, 1, 4)

_memo: dict[tuple, object] = {}


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    app = spark.conf.get("spark.app.id", None) or str(id(spark))
    return (app, sf_dir.rstrip("/"), what)


def _ts_text(col: str) -> F.Column:
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss").alias(col)


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = RM.calendar_bounds(spark, sf_dir)
    return build_date_dimension(spark, lo, hi)


def _sized(spark: SparkSession, sf_dir: str) -> AbstractContextManager[None]:
    """What runs in it has shuffles sized by the rows of lineitem, as its file footers have them."""
    return sized_shuffles(spark, spark.read.parquet(f"{sf_dir}/lineitem.parquet").count())


def _base_warehouse(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """Empty warehouse with calendar and SKU mapper published."""
    wh = Warehouse(scratch_dir(spark, label))
    lo, hi = RM.calendar_bounds(spark, sf_dir)
    write_date_dimension(spark, wh.date, lo, hi)
    with _sized(spark, sf_dir):
        publish_lookup(RM.mapper_for(spark, sf_dir), wh.sku_mapper, wh.sku_mapper_raw)
    return wh


def _deliveries_root(spark: SparkSession, sf_dir: str) -> str:
    """Deliveries A and B exported as CSV folders (A in week=1998-12-27, B in week=2001-11-04)."""
    k = _key(spark, sf_dir, "deliveries")
    if k not in _memo:
        root = scratch_dir(spark, "deliveries")
        with _sized(spark, sf_dir):
            export_extract(RM.first_delivery(spark, sf_dir), root, DELIVERY_A)
            export_extract(RM.restated_delivery(spark, sf_dir), root, DELIVERY_B)
        _memo[k] = root
    return _memo[k]


def _folder(root: str, day: _dt.date) -> str:
    return f"{root}/week={day.isoformat()}"


def _after_a(spark: SparkSession, sf_dir: str) -> Warehouse:
    k = _key(spark, sf_dir, "after_a")
    if k not in _memo:
        root = _deliveries_root(spark, sf_dir)
        wh = _base_warehouse(spark, sf_dir, "wh-a")
        run_weekly(spark, wh, _folder(root, DELIVERY_A), TS_A)
        _memo[k] = wh
    return _memo[k]


def _after_ab(spark: SparkSession, sf_dir: str) -> Warehouse:
    k = _key(spark, sf_dir, "after_ab")
    if k not in _memo:
        root = _deliveries_root(spark, sf_dir)
        wh = _base_warehouse(spark, sf_dir, "wh-ab")
        run_weekly(spark, wh, _folder(root, DELIVERY_A), TS_A)
        run_weekly(spark, wh, _folder(root, DELIVERY_B), TS_B)
        _memo[k] = wh
    return _memo[k]


def _facts_a_and_ab(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The fact's values after A, kept before the same warehouse takes B, and after A and B."""
    k = _key(spark, sf_dir, "after_ab")
    if k in _memo:
        return _fact_values(_after_a(spark, sf_dir).read_sales(spark)), _fact_values(_memo[k].read_sales(spark))
    root = _deliveries_root(spark, sf_dir)
    wh = _base_warehouse(spark, sf_dir, "wh-ab")
    run_weekly(spark, wh, _folder(root, DELIVERY_A), TS_A)
    a = _kept(_fact_values(wh.read_sales(spark)), "after-a")
    run_weekly(spark, wh, _folder(root, DELIVERY_B), TS_B)
    _memo[k] = wh
    return a, _fact_values(wh.read_sales(spark))


def _weekly_root(spark: SparkSession, sf_dir: str) -> str:
    """The gross extract exported one folder per week."""
    k = _key(spark, sf_dir, "weekly_root")
    if k not in _memo:
        root = scratch_dir(spark, "weekly")
        with _sized(spark, sf_dir):
            export_extract(RM.full_extract(spark, sf_dir), root)
        # a delivery with a header line and no rows
        nothing = RM.full_extract(spark, sf_dir).limit(0).coalesce(1)
        nothing.write.option("header", "true").csv(_folder(root, EMPTY_DELIVERY))
        _memo[k] = root
    return _memo[k]


def _enriched_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_extract(conform_extract(RM.full_extract(spark, sf_dir)), RM.mapper_for(spark, sf_dir))


def _classified_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery B classified against the warehouse after A (nothing written)."""
    wh = _after_a(spark, sf_dir)
    enriched = enrich_extract(conform_extract(RM.restated_delivery(spark, sf_dir)), wh.read_sku_mapper(spark))
    resolved = resolve_keys(enriched, wh.read_date(spark))
    touched = touched_date_ids(resolved)
    existing = wh.read_sales(spark).where(F.col("DateId").isin(touched))
    return merge_fact(existing, resolved, TS_B, 2, data_source=schemas.DATA_SOURCE_MAT)


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once, for steps that read it several times."""
    path = scratch_dir(df.sparkSession, label)
    write_table(df, path, "overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fact_values(df: DataFrame) -> DataFrame:
    return df.select(*FACT_KEY, *FACT_VALUES)


def _fact_with_audit(df: DataFrame) -> DataFrame:
    return df.select(
        *FACT_KEY,
        *FACT_VALUES,
        _ts_text("CreatedTime"),
        "CreatedByBatchId",
        _ts_text("UpdatedTime"),
        "UpdatedByBatchId",
    )


# ---------------------------------------------------------------- sources / sinks

def q_weekly_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: weekly extract from the transaction tables."""
    return RM.full_extract(spark, sf_dir)


def q_scan_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported weekly CSV folders scanned back (all part files, header skipped)."""
    return read_extract(spark, _weekly_root(spark, sf_dir))


def q_export_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data lines of the exported files, with their week folder."""
    return read_extract_lines(spark, _weekly_root(spark, sf_dir))


def q_read_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: an existing table plus a missing one (read as empty) with the same schema."""
    wh = _after_ab(spark, sf_dir)
    present = read_or_empty(spark, wh.product, schemas.PRODUCT)
    missing = read_or_empty(spark, wh.root + "/no_such_table", schemas.PRODUCT)
    return present.unionByName(missing).select("ProductId", "ProductName", "ProductType")


def q_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact partitions of A replaced by B's rows for B's weeks (dynamic partition overwrite)."""
    wa = _after_a(spark, sf_dir)
    path = scratch_dir(spark, "replace") + "/sales"
    write_table(wa.read_sales(spark), path, "partitions", "DateId")
    enriched = enrich_extract(conform_extract(RM.restated_delivery(spark, sf_dir)), wa.read_sku_mapper(spark))
    b_rows = resolve_keys(enriched, wa.read_date(spark))
    write_table(
        b_rows.select(*FACT_KEY, *FACT_VALUES, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SALES.fields[7:]]),
        path,
        "partitions",
        "DateId",
    )
    return _fact_values(read_or_empty(spark, path, schemas.SALES))


def q_publish_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SKU mapper published to the warehouse and the raw zone, both read back."""
    wh = _after_ab(spark, sf_dir)
    edw = read_or_empty(spark, wh.sku_mapper, schemas.SKU_MAPPER).withColumn("copy", F.lit("edw"))
    raw = read_or_empty(spark, wh.sku_mapper_raw, schemas.SKU_MAPPER).withColumn("copy", F.lit("raw"))
    return edw.unionByName(raw)


# ---------------------------------------------------------------- projections / filters

def q_conform_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract renamed to fact vocabulary, source tag, money as DECIMAL(13,2)."""
    return conform_extract(RM.full_extract(spark, sf_dir))


def q_stamp_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product as a new member of an empty dimension, stamped with the load time."""
    empty = spark.createDataFrame([], schemas.PRODUCT)
    found = _kept(product_candidates(_enriched_full(spark, sf_dir)), "products")
    fresh = new_members(found, empty, "ProductName", "ProductId", TS_A)
    return fresh.select("ProductId", "ProductName", "ProductType", _ts_text("CreatedTime"), "CreatedByBatchId",
                        _ts_text("UpdatedTime"), "UpdatedByBatchId")


def q_filter_retailers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SKU mapper rows of a given list of retailers (``isin``)."""
    return RM.mapper_for(spark, sf_dir).where(F.col("Retailer").isin(EXAMPLE_RETAILERS))


def q_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: keys of delivery B already loaded with different values (null-safe), old and new side by side."""
    wh = _after_a(spark, sf_dir)
    enriched = enrich_extract(conform_extract(RM.restated_delivery(spark, sf_dir)), wh.read_sku_mapper(spark))
    resolved = resolve_keys(enriched, wh.read_date(spark))
    with _sized(spark, sf_dir):
        existing = wh.read_sales(spark).where(F.col("DateId").isin(touched_date_ids(resolved)))
        return _kept(changed_rows(existing, resolved), "changed")


def q_week_endings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Sundays of the calendar (the days weekly extracts are dated)."""
    return _calendar(spark, sf_dir).where(is_week_end("Date")).select("DateId", "Date")


# ---------------------------------------------------------------- joins

def q_enrich_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract left-joined to the SKU mapper on (SKU, Retailer)."""
    return _enriched_full(spark, sf_dir)


def q_resolve_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows with DateId (calendar), ProductId and RetailerId."""
    return resolve_keys(_enriched_full(spark, sf_dir), _calendar(spark, sf_dir))


def _first_week_dim(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """A dimension as loaded from the first weekly delivery only (in memory)."""
    lineitem, supplier = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "supplier"))
    week1 = RM.weekly_extract(lineitem, supplier, weeks_from=FIRST_WEEK, weeks_before=FIRST_WEEK + _dt.timedelta(days=7))
    if kind == "product":
        enriched = enrich_extract(conform_extract(week1), RM.mapper_for(spark, sf_dir))
        empty = spark.createDataFrame([], schemas.PRODUCT)
        return _kept(new_members(_kept(product_candidates(enriched), "products"), empty, "ProductName", "ProductId", TS_A), "first-week")
    empty = spark.createDataFrame([], schemas.RETAILER)
    return _kept(new_members(_kept(retailer_candidates(week1), "retailers"), empty, "RetailerName", "RetailerId", TS_A), "first-week")


def q_new_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the whole extract that the dimension after the first week does not hold."""
    fresh = new_members(
        _kept(product_candidates(_enriched_full(spark, sf_dir)), "products"), _first_week_dim(spark, sf_dir, "product"),
        "ProductName", "ProductId", TS_B,
    )
    return fresh.select("ProductId", "ProductName", "ProductType")


def q_new_retailers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retailers of the whole extract that the dimension after the first week does not hold."""
    fresh = new_members(
        _kept(retailer_candidates(RM.full_extract(spark, sf_dir)), "retailers"), _first_week_dim(spark, sf_dir, "retailer"),
        "RetailerName", "RetailerId", TS_B,
    )
    return fresh.select("RetailerId", "RetailerName")


def q_fact_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of B whose key the fact after A does not hold."""
    with _sized(spark, sf_dir):
        return _kept(_fact_values(_classified_b(spark, sf_dir).where(F.col("_action") == "insert")), "inserts")


def q_fact_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows of B's weeks that B does not mention."""
    with _sized(spark, sf_dir):
        return _kept(_fact_values(_classified_b(spark, sf_dir).where(F.col("_action") == "keep")), "keeps")


def q_fact_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of B that change a stored row (new values, original creation)."""
    with _sized(spark, sf_dir):
        return _kept(_fact_with_audit(_classified_b(spark, sf_dir).where(F.col("_action") == "update")), "updates")


def q_view_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales view after A and B."""
    wh = _after_ab(spark, sf_dir)
    return view_sales(wh.read_sales(spark), wh.read_product(spark), wh.read_retailer(spark), wh.read_date(spark))


# ---------------------------------------------------------------- aggregation and gates

def q_distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: distinct (ProductName, ProductType) of the enriched extract."""
    return product_candidates(_enriched_full(spark, sf_dir))


def q_distinct_retailers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: distinct retailers of the extract."""
    return retailer_candidates(RM.full_extract(spark, sf_dir))


def q_max_or_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: largest weekly unit figure, 0 for an empty extract."""
    return Q.max_or_zero(RM.full_extract(spark, sf_dir), "Units")


def q_gate_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: is the plain part name unique? (It is not - hence the '#partkey' in Description.)"""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return Q.gate_report(part, "Part Table", [Q.unique("p_name")])


def q_gate_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: is (l_orderkey, l_linenumber) a key of lineitem? (It is not in this data.)"""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return Q.gate_report(lineitem, "Lineitem Table", [Q.unique("l_orderkey", "l_linenumber")])


def q_gate_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: does every extract row map to a product description?"""
    return Q.gate_report(_enriched_full(spark, sf_dir), "Enriched Extract", [Q.not_null("Description")])


def q_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: the sales-fact gate over delivery B merged onto the fact after A."""
    return Q.gate_report(_classified_b(spark, sf_dir), SALES_TABLE, SALES_GATE)


# ---------------------------------------------------------------- set operations

def q_merge_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension after A plus B's new products."""
    wh = _after_a(spark, sf_dir)
    enriched = enrich_extract(conform_extract(RM.restated_delivery(spark, sf_dir)), wh.read_sku_mapper(spark))
    old = wh.read_product(spark)
    fresh = new_members(_kept(product_candidates(enriched), "products"), old, "ProductName", "ProductId", TS_B, 2)
    return merge_dim(old, fresh).select("ProductId", "ProductName", "ProductType", "CreatedByBatchId")


def q_table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact after A vs fact after A and B, as a multiset difference."""
    a, ab = _facts_a_and_ab(spark, sf_dir)
    with _sized(spark, sf_dir):
        return _kept(table_diff(a, ab), "diff")


# ---------------------------------------------------------------- scalar functions

def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids of every product description and retailer name of the mapper."""
    m = RM.mapper_for(spark, sf_dir)
    products = m.select(F.lit("product").alias("Kind"), F.col("Description").alias("Name")).distinct()
    retailers = m.select(F.lit("retailer").alias("Kind"), F.col("Retailer").alias("Name")).distinct()
    return products.unionByName(retailers).select("Kind", "Name", surrogate_key("Name").alias("Id"))


def q_surrogate_key_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """63-bit ids of every product description of the mapper, as a warehouse has them by default."""
    names = RM.mapper_for(spark, sf_dir).select(F.col("Description").alias("Name")).distinct()
    return names.select("Name", wide_key("Name").alias("Id"))


def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """week texts of every shipped line parsed back (dd/MM/yyyy), and the same texts under a pattern they don't fit."""
    from .functions.calendar import week_ending

    week = week_ending(F.to_date("l_shipdate"))
    texts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(extract_date_text(week).alias("Text")).distinct()
    return texts.select("Text", parse_date("Text").alias("Date"), parse_date("Text", "yyyy-MM-dd").alias("Other"))


def q_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: lines of the exported files, and those whose sort key (Retailer, SKU) is none before the line above, by week folder."""
    order = read_export_order(spark, _weekly_root(spark, sf_dir))
    with _sized(spark, sf_dir):
        return _kept(order.groupBy("folder").agg(F.count(F.lit(1)).alias("lines"), F.count_if("in_order").alias("in_order")), "order")


def q_line_amount_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """round(price x units, 2) of discounted prices, which have four decimals."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    units = F.col("l_quantity").try_cast("int")
    price = to_money("p_retailprice") * (F.lit(1) - to_money("l_discount"))
    return li.join(part, "l_partkey", "left").select(
        F.col("l_partkey").cast("long").alias("SKU"), price.try_cast("decimal(16,4)").alias("Price"), units.alias("Units"),
        line_amount(price, units).alias("Sales"),
    )


def q_view_product_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product view as it is by default, without ids."""
    return view_product(_after_ab(spark, sf_dir).read_product(spark))


def q_view_retailer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retailer view as it is by default, without ids."""
    return view_retailer(_after_ab(spark, sf_dir).read_retailer(spark))


def q_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar columns of every shipping date."""
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.to_date("l_shipdate").alias("d")).distinct()
    return days.select(*date_parts("d"))


def q_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: every day from the first shipping date up to (excluding) the last."""
    row = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(
        F.min(F.to_date("l_shipdate")).alias("lo"), F.max(F.to_date("l_shipdate")).alias("hi")
    ).first()
    return date_range(spark, row["lo"], row["hi"])


def q_line_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per shipped line, week text (dd/MM/yyyy), units and list-price amount round(price x units, 2)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    from .functions.calendar import week_ending

    units = F.col("l_quantity").try_cast("int")
    return li.join(part, "l_partkey", "left").select(
        F.col("l_partkey").cast("long").alias("SKU"),
        extract_date_text(week_ending(F.to_date("l_shipdate"))).alias("Week Ending"),
        units.alias("Units"),
        line_amount("p_retailprice", units).alias("Sales"),
    )


# ---------------------------------------------------------------- composite operators

def q_date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar from 1 Jan of the first shipping year to 1 Jan after the last."""
    return _calendar(spark, sf_dir)


def q_load_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension after A and B (insert-only: first load time kept)."""
    p = _after_ab(spark, sf_dir).read_product(spark)
    return p.select("ProductId", "ProductName", "ProductType", _ts_text("CreatedTime"), "CreatedByBatchId")


def q_load_retailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retailer dimension after A and B."""
    r = _after_ab(spark, sf_dir).read_retailer(spark)
    return r.select("RetailerId", "RetailerName", _ts_text("CreatedTime"), "CreatedByBatchId")


def q_upsert_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: sales fact after A then B, with audit columns."""
    return _fact_with_audit(_after_ab(spark, sf_dir).read_sales(spark))


def q_upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: A, then B, then B again - the replay changes nothing."""
    root = _deliveries_root(spark, sf_dir)
    wh = _base_warehouse(spark, sf_dir, "wh-replay")
    run_weekly(spark, wh, _folder(root, DELIVERY_A), TS_A)
    run_weekly(spark, wh, _folder(root, DELIVERY_B), TS_B)
    run_weekly(spark, wh, _folder(root, DELIVERY_B), TS_C)
    return _fact_with_audit(wh.read_sales(spark))


def q_view_retailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retailer view (with ids) after A and B."""
    return view_retailer(_after_ab(spark, sf_dir).read_retailer(spark), with_ids=True)


def q_view_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product view (with ids) after A and B."""
    return view_product(_after_ab(spark, sf_dir).read_product(spark), with_ids=True)


def q_register_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every weekly folder registered at once (ids in folder order), one without rows too, then a second, idempotent pass."""
    root = _weekly_root(spark, sf_dir)
    path = scratch_dir(spark, "batches") + "/batch"
    folders = delivery_folders(spark, root)
    for _ in range(2):
        log = read_or_empty(spark, path, schemas.BATCH)
        fresh = register_batches(log, folders, schemas.DATA_SOURCE_MAT)
        write_table(fresh, path, "append")
    log = read_or_empty(spark, path, schemas.BATCH)
    return log.select("BatchId", "DataSource", F.regexp_extract("FilePath", r"([^/]+)$", 1).alias("Folder"))


def q_backfill_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries loaded in one pass - equal to loading A then B, batch ids included (times are the one run's)."""
    root = _deliveries_root(spark, sf_dir)
    wh = _base_warehouse(spark, sf_dir, "wh-backfill")
    backfill(spark, wh, root, TS_A)
    return _fact_with_audit(wh.read_sales(spark))


def q_backfill_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries loaded in one pass, and again in another - the repeat writes nothing, so times are the first run's."""
    root = _deliveries_root(spark, sf_dir)
    wh = _base_warehouse(spark, sf_dir, "wh-again")
    backfill(spark, wh, root, TS_A)
    again = backfill(spark, wh, root, TS_C)
    if again.written_date_ids:
        raise RuntimeError(f"a repeated backfill wrote {again.written_date_ids}")
    return _fact_with_audit(wh.read_sales(spark))


def q_late_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery B arrives before A - values as in date order, and each row with the dates of the deliveries behind it."""
    root = _deliveries_root(spark, sf_dir)
    wh = _base_warehouse(spark, sf_dir, "wh-late")
    run_weekly(spark, wh, _folder(root, DELIVERY_B), TS_A)
    run_weekly(spark, wh, _folder(root, DELIVERY_A), TS_B)
    dates = F.array_join(F.transform(schemas.HISTORY, lambda d: F.date_format(d["ord"], "yyyy-MM-dd")), ",")
    return wh.read_sales_history(spark).select(*FACT_KEY, *FACT_VALUES, dates.alias("Dates"))


def q_stream_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 (streaming): both delivery folders picked up by a file stream and loaded per micro-batch."""
    from .streaming.arrivals import start_arrivals

    root = _deliveries_root(spark, sf_dir)
    wh = _base_warehouse(spark, sf_dir, "wh-stream")
    query = start_arrivals(spark, wh, root, name=None, checkpoint=scratch_dir(spark, "stream-ckpt"))
    query.awaitTermination()
    return wh.read_sales(spark).select(*FACT_KEY, *FACT_VALUES, "CreatedByBatchId", "UpdatedByBatchId")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "weekly_extract": q_weekly_extract,
    "scan_extract": q_scan_extract,
    "export_extract": q_export_extract,
    "read_or_empty": q_read_or_empty,
    "table_replace": q_table_replace,
    "publish_lookup": q_publish_lookup,
    "conform_extract": q_conform_extract,
    "stamp_audit": q_stamp_audit,
    "filter_retailers": q_filter_retailers,
    "changed_rows": q_changed_rows,
    "week_endings": q_week_endings,
    "enrich_extract": q_enrich_extract,
    "resolve_keys": q_resolve_keys,
    "new_products": q_new_products,
    "new_retailers": q_new_retailers,
    "fact_inserts": q_fact_inserts,
    "fact_keeps": q_fact_keeps,
    "fact_updates": q_fact_updates,
    "view_sales": q_view_sales,
    "distinct_products": q_distinct_products,
    "distinct_retailers": q_distinct_retailers,
    "max_or_zero": q_max_or_zero,
    "gate_unique": q_gate_unique,
    "gate_unique_key": q_gate_unique_key,
    "gate_not_null": q_gate_not_null,
    "gate_report": q_gate_report,
    "merge_dim": q_merge_dim,
    "table_diff": q_table_diff,
    "surrogate_key": q_surrogate_key,
    "surrogate_key_wide": q_surrogate_key_wide,
    "parse_dates": q_parse_dates,
    "export_order": q_export_order,
    "line_amount_net": q_line_amount_net,
    "view_product_names": q_view_product_names,
    "view_retailer_names": q_view_retailer_names,
    "date_parts": q_date_parts,
    "date_range": q_date_range,
    "line_amount": q_line_amount,
    "date_dimension": q_date_dimension,
    "load_product": q_load_product,
    "load_retailer": q_load_retailer,
    "upsert_sales": q_upsert_sales,
    "upsert_replay": q_upsert_replay,
    "view_retailer": q_view_retailer,
    "view_product": q_view_product,
    "register_batches": q_register_batches,
    "backfill_weeks": q_backfill_weeks,
    "backfill_replay": q_backfill_replay,
    "late_delivery": q_late_delivery,
    "stream_deliveries": q_stream_deliveries,
}
