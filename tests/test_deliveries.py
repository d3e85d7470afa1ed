"""Deliveries have an order of their own: repeats change nothing, late ones take their place."""

import datetime as dt
import decimal
import os

import pytest
from fixtures import SUNDAY1, SUNDAY2, WEEK1, WEEK2, line, warehouse_with_lookups, write_csv
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.operators.diff import table_diff
from tillroll.operators.fact import merge_fact
from tillroll.plans import weekly_load
from tillroll.plans.weekly_load import backfill, run_weekly
from tillroll.sources.tables import Warehouse
from tillroll.streaming.arrivals import load_arrived

TS = ["2023-04-01 06:00:00", "2023-04-08 06:00:00", "2023-04-15 06:00:00", "2023-04-22 06:00:00"]
DELIVERIES = {
    "week=2023-03-05": WEEK1,
    "week=2023-03-12": [*WEEK2, line(52, "Halden", SUNDAY1, 70.0, "7.00")],
    "week=2023-03-19": [line(52, "Halden", SUNDAY1, 40.0, "61.20"), line(711, "Northgate", SUNDAY2, 8.0, "25.60")],
    "week=2023-03-26": [line(52, "Halden", SUNDAY1, 40.0, "61.20")],
}


def _files(wh):
    return sorted(f"{d}/{f}:{os.stat(f'{d}/{f}').st_mtime_ns}" for d, _, fs in os.walk(wh.sales) for f in fs if f.endswith(".parquet"))


def _lake(spark, root, name):
    wh = Warehouse(f"{root}/{name}")
    warehouse_with_lookups(spark, wh)
    return wh


def _by_folder(spark, wh):
    """The fact with folder names in place of batch numbers, which follow arrival."""
    names = {r.BatchId: os.path.basename(r.FilePath) for r in wh.read_batches(spark).collect()}
    return sorted(
        ((r.DateId, r.ProductId, r.RetailerId, r.DataSource, r.SKU, r.UnitsSold, r.SalesAmount), names[r.CreatedByBatchId], names.get(r.UpdatedByBatchId))
        for r in wh.read_sales(spark).collect()
    )


@pytest.fixture
def raw(tmp_root):
    for name, lines in DELIVERIES.items():
        write_csv(f"{tmp_root}/raw/{name}", lines)
    return f"{tmp_root}/raw"


def test_a_repeated_backfill_writes_nothing(spark, tmp_root, raw):
    wh = _lake(spark, tmp_root, "lake")
    backfill(spark, wh, raw, TS[0])
    rows, files = wh.read_sales(spark).collect(), _files(wh)
    again = backfill(spark, wh, raw, TS[1])
    assert again.written_date_ids == [] and again.new_batches == 0 and _files(wh) == files
    # nor does a weekly load of an older one of them
    assert run_weekly(spark, wh, f"{raw}/week=2023-03-12", TS[2]).written_date_ids == []
    assert table_diff(wh.read_sales(spark), spark.createDataFrame(rows, wh.read_sales(spark).schema)).count() == 0


def test_any_order_of_arrival_gives_the_same(spark, tmp_root, raw, monkeypatch):
    """Values and audit ids as week by week in date order; a late delivery reads its own folder alone."""
    expected = _lake(spark, tmp_root, "expected")
    backfill(spark, expected, raw, TS[0])  # equals week by week: tests/test_pipeline.py
    want = _by_folder(spark, expected)
    row = next(r for r in want if r[0][4] == 52 and r[0][0] == 20230305)
    assert row[1:] == ("week=2023-03-05", "week=2023-03-19") and row[0][5] == 40

    names, read = list(DELIVERIES), []
    real = weekly_load.read_deliveries
    monkeypatch.setattr(weekly_load, "read_deliveries", lambda s, root, folders=None: read.append(folders) or real(s, root, folders))
    for k, order in enumerate([(2, 0, 3, 1)]):
        wh = _lake(spark, tmp_root, f"lake{k}")
        arrived = f"{tmp_root}/arrived{k}"
        for i, ts in zip(order, TS):
            write_csv(f"{arrived}/{names[i]}", DELIVERIES[names[i]])
            read.clear()
            load_arrived(spark, wh, arrived, [], ts)
            assert [[os.path.basename(f) for f in x] for x in read] == [[names[i]]]
        assert _by_folder(spark, wh) == want
        assert load_arrived(spark, wh, arrived, [], TS[3]) is None


def test_a_corrected_delivery_replaces_its_own_rows(spark, tmp_root, raw):
    wh = _lake(spark, tmp_root, "lake")
    backfill(spark, wh, raw, TS[0])
    write_csv(f"{raw}/week=2023-03-26", [line(52, "Halden", SUNDAY1, 41.0, "61.20")])
    run_weekly(spark, wh, f"{raw}/week=2023-03-26", TS[1])
    row = next(r for r in wh.read_sales(spark).collect() if r.SKU == 52 and r.DateId == 20230305)
    assert (row.UnitsSold, row.CreatedByBatchId, row.UpdatedByBatchId, row.UpdatedTime) == (41, 1, 4, dt.datetime(2023, 4, 8, 6))


def test_loads_without_a_date_apply_on_arrival(spark, tmp_root, raw):
    wh = _lake(spark, tmp_root, "lake")
    backfill(spark, wh, raw, TS[0])
    run_weekly(spark, wh, write_csv(f"{tmp_root}/by-hand", [line(52, "Halden", SUNDAY1, 99.0, "1.00")]), TS[1])
    stored = {(r.DateId, r.SKU): r for r in wh.read_sales_history(spark).collect()}
    assert stored[20230305, 52].UnitsSold == 99 and stored[20230305, 52][schemas.HISTORY] is None
    assert len(stored[20230312, 711][schemas.HISTORY]) == 2
    assert sorted(wh.read_sales(spark).columns) == sorted(schemas.SALES.names)


INCOMING = "DateId long, ProductId long, RetailerId long, DataSource string, SKU long, UnitsSold int, SalesAmount decimal(13,2), d date, b int"
days = st.sampled_from([dt.date(2022, 1, 2), dt.date(2022, 1, 9), dt.date(2022, 1, 16), dt.date(2022, 1, 23)])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.sampled_from([5, 6, None]), days), min_size=1, max_size=8, unique_by=lambda t: (t[0], t[2])), st.data())
def test_merge_in_parts_matches_one_in_order(spark, rows, data):
    """However the deliveries are dealt to loads: the state of a plain fold in date order."""

    def loaded(existing, part):
        frame = spark.createDataFrame([(20220102, p, 1, "MAT", 1, u, decimal.Decimal(1), d, d.day) for p, u, d in part], INCOMING)
        merged = merge_fact(existing, frame, "2022-02-01 00:00:00", delivery="d", batch_id_col="b")
        assert not any(r["_extra"] for r in merged.collect())
        return spark.createDataFrame(merged.select(*schemas.SALES_WITH_HISTORY.names).collect(), schemas.SALES_WITH_HISTORY)

    state = spark.createDataFrame([], schemas.SALES_WITH_HISTORY)
    for part in (rows[::2], rows[1::2], data.draw(st.permutations(rows))[:3]):
        state = loaded(state, part) if part else state
    want = {}
    for p, u, d in sorted(rows, key=lambda x: x[2]):
        if p not in want:
            want[p] = [u, d.day, None]
        elif want[p][0] != u:
            want[p] = [u, want[p][1], d.day]
    assert {r.ProductId: [r.UnitsSold, r.CreatedByBatchId, r.UpdatedByBatchId] for r in state.collect()} == want


def test_hot_key_of_a_backfill_is_combined_before_the_shuffle(spark):
    """A key that repeats in every delivery: counted map-side, one step a delivery, refused by the count."""
    rows = spark.range(0, 900).selectExpr(
        "20220102L DateId", "if(id % 3 = 0, 7, id) ProductId", "1L RetailerId", "'MAT' DataSource", "1L SKU", "1 UnitsSold", "cast(1 as decimal(13,2)) SalesAmount",
        "date_add(date'2022-01-02', cast(id % 2 as int) * 7) d", "1 b",
    ).repartition(4)
    merged = merge_fact(spark.createDataFrame([], schemas.SALES_WITH_HISTORY), rows, "2022-02-01 00:00:00", delivery="d", batch_id_col="b")
    hot = merged.where("ProductId = 7").first()
    assert (hot["_rows"], hot["_extra"], len(hot[schemas.HISTORY])) == (301, 299, 2)
    assert "partial_count" in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.agg(F.sum("_extra")).first()[0] == 299
