import datetime as dt
import decimal
import os

import pytest
from fixtures import (
    FIRST, LEMON, MAPPER_ROWS, NAMES, OAT, RYE, SECOND, SUNDAY1, SUNDAY2, SUNDAY3, TEA, WEEK1, WEEK2, line, warehouse_with_lookups, write_csv,
)

from tillroll.operators.diff import table_diff, tables_equal
from tillroll.operators.quality import GateError
from tillroll.operators.views import view_product, view_retailer, view_sales
from tillroll.plans.weekly_load import backfill, run_weekly
from tillroll.sources.tables import Warehouse, write_table

M = decimal.Decimal
TS1, TS2, TS3 = "2023-03-06 06:00:00", "2023-03-13 06:00:00", "2023-03-20 06:00:00"
AUDITED = ["DateId", "ProductId", "RetailerId", "DataSource", "SKU", "UnitsSold", "SalesAmount", "CreatedByBatchId", "UpdatedByBatchId"]


def _sales(spark, wh):
    v = view_sales(wh.read_sales(spark), wh.read_product(spark), wh.read_retailer(spark), wh.read_date(spark))
    return sorted(tuple(r) for r in v.collect())


def _expected(figures, day):
    """The view's rows of one week, from the figures and the mapper."""
    return [(day, NAMES[s, r][0], r, "MAT", s, u, M(v)) for s, r, u, v in figures]


def _setup(spark, tmp_root, mapper_rows=None, name="lake"):
    wh = Warehouse(f"{tmp_root}/{name}")
    warehouse_with_lookups(spark, wh, mapper_rows)
    raw = wh.raw_extracts
    return wh, raw, write_csv(f"{raw}/week=2023-03-05", WEEK1), write_csv(f"{raw}/week=2023-03-12", WEEK2)


def test_two_weeks(spark, tmp_root):
    wh, _, w1, w2 = _setup(spark, tmp_root)
    run_weekly(spark, wh, w1, TS1)
    assert [r.ProductName for r in view_product(wh.read_product(spark)).collect()] == [LEMON, OAT]
    assert [r.RetailerName for r in view_retailer(wh.read_retailer(spark)).collect()] == ["Halden", "Northgate"]
    assert _sales(spark, wh) == sorted(_expected(FIRST, SUNDAY1))
    run_weekly(spark, wh, w2, TS2)
    products = [tuple(r) for r in view_product(wh.read_product(spark)).collect()]
    assert products == [(TEA, "Drinks"), (LEMON, "Drinks"), (OAT, "Snacks"), (RYE, "Bread")]
    assert _sales(spark, wh) == sorted(_expected(FIRST, SUNDAY1) + _expected(SECOND, SUNDAY2))
    log = sorted((r.BatchId, os.path.basename(r.FilePath)) for r in wh.read_batches(spark).collect())
    assert log == [(1, "week=2023-03-05"), (2, "week=2023-03-12")]


def test_replay_changes_and_writes_nothing(spark, tmp_root):
    wh, _, w1, w2 = _setup(spark, tmp_root)
    run_weekly(spark, wh, w1, TS1)
    run_weekly(spark, wh, w2, TS2)
    before = wh.read_sales(spark).collect()
    files = sorted(f"{d}/{f}:{os.stat(f'{d}/{f}').st_mtime_ns}" for d, _, fs in os.walk(wh.sales) for f in fs if f.endswith(".parquet"))
    result = run_weekly(spark, wh, w2, TS3)
    assert result.touched_date_ids == [20230312] and result.written_date_ids == []
    after = wh.read_sales(spark)
    assert tables_equal(spark.createDataFrame(before, after.schema), after)
    assert files == sorted(f"{d}/{f}:{os.stat(f'{d}/{f}').st_mtime_ns}" for d, _, fs in os.walk(wh.sales) for f in fs if f.endswith(".parquet"))
    assert wh.read_batches(spark).count() == 2


def test_changed_and_null_to_value_rows_update(spark, tmp_root):
    wh, raw, w1, _ = _setup(spark, tmp_root)
    run_weekly(spark, wh, write_csv(f"{raw}/v1", [line(52, "Halden", SUNDAY1, "", "61.20"), WEEK1[1]]), TS1)
    run_weekly(spark, wh, write_csv(f"{raw}/v2", WEEK1), TS2)
    rows = {r.SKU: r for r in wh.read_sales(spark).collect()}
    assert rows[52].UnitsSold == 40  # null -> value is an update
    assert rows[52].UpdatedTime == dt.datetime(2023, 3, 13, 6, 0) and rows[52].CreatedTime == dt.datetime(2023, 3, 6, 6, 0)
    assert rows[710].UpdatedTime is None  # unchanged row kept as it was
    assert rows[52].CreatedByBatchId == 1 and rows[52].UpdatedByBatchId == 2


def test_unmapped_sku_aborts_and_writes_nothing(spark, tmp_root):
    wh, raw, w1, _ = _setup(spark, tmp_root)
    bad = write_csv(f"{raw}/bad", [line(9999, "Halden", SUNDAY1, 1.0, 1), *WEEK1])
    with pytest.raises(GateError, match="ETL: Product Dimension Table - ProductName must NOT have null values"):
        run_weekly(spark, wh, bad, TS1)
    for read in (wh.read_product, wh.read_retailer, wh.read_sales, wh.read_batches):
        assert read(spark).count() == 0
    run_weekly(spark, wh, w1, TS1)  # what was staged and refused is not published later
    assert wh.read_batches(spark).count() == 1


def test_mapper_duplicate_aborts(spark, tmp_root):
    wh, _, w1, _ = _setup(spark, tmp_root, MAPPER_ROWS + [(52, "Halden", "Other Name", "Snacks")])
    with pytest.raises(GateError, match=r"List\(SKU, Retailer\) must NOT have duplicates"):
        run_weekly(spark, wh, w1, TS1)


def test_mapper_duplicate_of_other_pairs_does_not(spark, tmp_root):
    wh, _, w1, _ = _setup(spark, tmp_root, MAPPER_ROWS + [(9, "Ostrava Foods", "Other Name", "Snacks")])
    run_weekly(spark, wh, w1, TS1)
    assert wh.read_sales(spark).count() == 2


def test_duplicate_fact_key_aborts(spark, tmp_root):
    wh, raw, _, _ = _setup(spark, tmp_root)
    dup = write_csv(f"{raw}/dup", [WEEK1[0], line(52, "Halden", SUNDAY1, 41.0, "61.20")])
    with pytest.raises(GateError) as err:
        run_weekly(spark, wh, dup, TS1)
    assert str(err.value) == "ETL: Sales Fact Table - List(DateId, ProductId, RetailerId) must NOT have duplicates"
    assert wh.read_sales(spark).count() == 0


def test_date_outside_calendar_aborts(spark, tmp_root):
    wh, raw, _, _ = _setup(spark, tmp_root)
    with pytest.raises(GateError, match="ETL: Sales Fact Table - DateId must NOT have null values"):
        run_weekly(spark, wh, write_csv(f"{raw}/old", ["52,Halden,05/03/23,40.0,61.20"]), TS1)  # year 0023


def test_backfill_equals_week_by_week_with_audit_ids(spark, tmp_root):
    """A third delivery restates the first week, after the mapper has given a product another type."""
    wh, raw, w1, w2 = _setup(spark, tmp_root)
    retyped = [(s, r, n, "Pantry" if n == OAT else k) for s, r, n, k in MAPPER_ROWS]
    w3 = write_csv(f"{raw}/week=2023-03-19", [line(52, "Halden", SUNDAY1, 50.0, "70.00"), line(9, "Ostrava Foods", SUNDAY3, 5.0, 10)])
    for path, ts in [(w1, TS1), (w2, TS2)]:
        run_weekly(spark, wh, path, ts)
    warehouse_with_lookups(spark, wh, retyped)
    run_weekly(spark, wh, w3, TS3)
    assert {r.ProductName: r.ProductType for r in wh.read_product(spark).collect()}[OAT] == "Snacks"  # the first load's

    one_pass = Warehouse(f"{tmp_root}/lake2")
    warehouse_with_lookups(spark, one_pass)
    backfill(spark, one_pass, raw, TS3)
    assert _sales(spark, one_pass) == _sales(spark, wh)
    assert table_diff(one_pass.read_sales(spark).select(*AUDITED), wh.read_sales(spark).select(*AUDITED)).count() == 0
    restated = [r for r in one_pass.read_sales(spark).collect() if r.SKU == 52 and r.DateId == 20230305]
    assert [(r.CreatedByBatchId, r.UpdatedByBatchId) for r in restated] == [(1, 3)]
    batches = lambda w: sorted((r.ProductName, r.CreatedByBatchId) for r in w.read_product(spark).collect())
    assert batches(one_pass) == batches(wh) and one_pass.read_batches(spark).count() == 3


def test_second_source_is_tagged(spark, tmp_root):
    wh, _, w1, _ = _setup(spark, tmp_root)
    run_weekly(spark, wh, w1, TS1, data_source="OTHER")
    assert {r.DataSource for r in wh.read_sales(spark).collect()} == {"OTHER"} == {r.DataSource for r in wh.read_batches(spark).collect()}


def test_delivery_without_rows_is_registered(spark, tmp_root):
    wh, raw, _, _ = _setup(spark, tmp_root)
    empty = write_csv(f"{raw}/week=2023-03-26", [])
    run_weekly(spark, wh, empty, TS1)
    assert [os.path.basename(r.FilePath) for r in wh.read_batches(spark).collect()] == ["week=2023-03-26"]
    assert wh.read_sales(spark).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_default_load_time_is_now_in_any_zone(spark, tmp_root, zone):
    wh, _, w1, _ = _setup(spark, tmp_root)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        run_weekly(spark, wh, w1)
        late = wh.read_sales(spark).selectExpr("unix_timestamp(current_timestamp()) - unix_timestamp(CreatedTime) AS s").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(0 <= r.s < 600 for r in late)


def test_ids_of_a_warehouse(spark, tmp_root):
    """The width is stored and another one refused; narrow ids are the contract's; tampered dimensions are noticed."""
    wh, _, w1, w2 = _setup(spark, tmp_root)
    run_weekly(spark, wh, w1, TS1, bits=32)
    with pytest.raises(ValueError, match="32 bits"):
        run_weekly(spark, wh, w2, TS2, bits=63)
    run_weekly(spark, wh, w2, TS2)
    assert len(_sales(spark, wh)) == 5
    assert all(r.ProductId < 2**32 for r in wh.read_product(spark).collect())
    broken = wh.read_product(spark).selectExpr("ProductId + 1 AS ProductId", "* EXCEPT (ProductId)").collect()
    write_table(spark.createDataFrame(broken, wh.read_product(spark).schema), wh.product, "overwrite")
    with pytest.raises(GateError, match="ProductId must be in the Product Dimension Table"):
        run_weekly(spark, wh, w1, TS3)


@pytest.mark.parametrize("bits", [5])
def test_colliding_ids_are_settled(spark, tmp_root, bits):
    """With four products and three retailers on a few bits: unique ids, the same sales."""
    wh, raw, w1, w2 = _setup(spark, tmp_root)
    run_weekly(spark, wh, w1, TS1, bits=bits)
    run_weekly(spark, wh, w2, TS2)
    ids = [r.ProductId for r in wh.read_product(spark).collect()]
    assert len(set(ids)) == 4 and max(ids) < 2**bits
    assert _sales(spark, wh) == sorted(_expected(FIRST, SUNDAY1) + _expected(SECOND, SUNDAY2))


def test_table_diff_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    got = sorted(tuple(r) for r in table_diff(a, b).collect())
    assert got == [(1, "left_only", 1), (2, "left_only", 1), (3, "right_only", 1)]
