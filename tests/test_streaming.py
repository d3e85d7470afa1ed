import os

import pytest
from fixtures import SUNDAY1, WEEK1, WEEK2, line, warehouse_with_lookups, write_csv
from pyspark.errors import StreamingQueryException

from tillroll.operators.diff import table_diff
from tillroll.plans.weekly_load import run_weekly
from tillroll.sources.tables import Warehouse
from tillroll.streaming.arrivals import start_arrivals

VALUES = ["DateId", "ProductId", "RetailerId", "DataSource", "SKU", "UnitsSold", "SalesAmount"]


def _run(spark, wh, raw, ckpt):
    q = start_arrivals(spark, wh, raw, name=None, checkpoint=ckpt)
    q.awaitTermination()


def _warehouse(spark, path):
    wh = Warehouse(path)
    warehouse_with_lookups(spark, wh)
    return wh


def test_stream_equals_week_by_week_whatever_arrives_first(spark, tmp_root):
    """The third delivery arrives first; the second, older one restates the same key; one delivery has no rows."""
    raw, source = f"{tmp_root}/raw", f"{tmp_root}/source"
    made = {
        "week=2023-03-05": WEEK1,
        "week=2023-03-12": [*WEEK2, line(52, "Halden", SUNDAY1, 70.0, "7.00")],
        "week=2023-03-19": [line(52, "Halden", SUNDAY1, 50.0, "5.00")],
    }
    expected = _warehouse(spark, f"{tmp_root}/lake1")
    for name, lines in made.items():
        run_weekly(spark, expected, write_csv(f"{source}/{name}", lines), "2023-03-20 06:00:00")

    streamed, ckpt = _warehouse(spark, f"{tmp_root}/lake2"), f"{tmp_root}/ckpt"
    for name in ("week=2023-03-05", "week=2023-03-19"):
        write_csv(f"{raw}/{name}", made[name])
    _run(spark, streamed, raw, ckpt)
    write_csv(f"{raw}/week=2023-03-12", made["week=2023-03-12"])
    write_csv(f"{raw}/week=2023-03-26", [])
    _run(spark, streamed, raw, ckpt)
    assert table_diff(streamed.read_sales(spark).select(*VALUES), expected.read_sales(spark).select(*VALUES)).count() == 0
    assert {os.path.basename(r.FilePath) for r in streamed.read_batches(spark).collect()} == {*made, "week=2023-03-26"}


def test_split_delivery_is_one_delivery(spark, tmp_root):
    """A second file of a loaded delivery repeats a key with another value: refused, as in a weekly load."""
    raw = f"{tmp_root}/raw"
    wh, ckpt = _warehouse(spark, f"{tmp_root}/lake"), f"{tmp_root}/ckpt"
    folder = write_csv(f"{raw}/week=2023-03-05", WEEK1)
    _run(spark, wh, raw, ckpt)
    write_csv(folder, [line(52, "Halden", SUNDAY1, 41.0, "60.00")], name="more.csv")
    with pytest.raises(StreamingQueryException, match="must NOT have duplicates"):
        _run(spark, wh, raw, ckpt)
    assert {r.UnitsSold for r in wh.read_sales(spark).collect()} == {40, 15}
