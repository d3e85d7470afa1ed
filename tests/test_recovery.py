"""A load cut short anywhere is finished by the next one."""

import glob
import shutil

import pytest
from fixtures import SUNDAY1, WEEK1, WEEK2, line, warehouse_with_lookups, write_csv

from tillroll.operators.diff import table_diff
from tillroll.plans import publish, weekly_load
from tillroll.plans.weekly_load import run_weekly
from tillroll.sources import lease
from tillroll.sources.lease import LeaseLost, WarehouseBusy
from tillroll.sources.tables import Warehouse

TS1, TS2, TS3 = "2023-03-06 06:00:00", "2023-03-13 06:00:00", "2023-03-20 06:00:00"


def _two(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    w1 = write_csv(f"{raw}/week=2023-03-05", WEEK1)
    w2 = write_csv(f"{raw}/week=2023-03-12", [*WEEK2, line(52, "Halden", SUNDAY1, 99.0, "1.00")])
    out = []
    for name in ("clean", "lake"):
        wh = Warehouse(f"{tmp_root}/{name}")
        warehouse_with_lookups(spark, wh)
        run_weekly(spark, wh, w1, TS1)
        out.append(wh)
    run_weekly(spark, out[0], w2, TS2)
    return *out, w1, w2


def _same(spark, a, b):
    tables = [(a.read_sales(spark), b.read_sales(spark)), (a.read_product(spark), b.read_product(spark)), (a.read_retailer(spark), b.read_retailer(spark))]
    assert all(table_diff(x, y).count() == 0 for x, y in tables)
    assert a.read_batches(spark).count() == b.read_batches(spark).count()


@pytest.mark.parametrize("lost", ["sales", "product", "batch"])
def test_killed_while_publishing(spark, tmp_root, monkeypatch, lost):
    """Killed at a table's write: rows that stay (keep) and audit values come back from staging, as of the load."""
    clean, wh, w1, w2 = _two(spark, tmp_root)
    real = publish.write_table

    def dies(df, path, mode, partition_by=None):
        if path == getattr(wh, lost):
            if lost == "sales":  # the commit has removed the old week and not yet put the new one
                for week in glob.glob(f"{wh.sales}/DateId=20230305"):
                    shutil.rmtree(week)
            raise RuntimeError("killed")
        return real(df, path, mode, partition_by)

    monkeypatch.setattr(publish, "write_table", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run_weekly(spark, wh, w2, TS2)
    monkeypatch.setattr(publish, "write_table", real)
    assert publish.recover(spark, wh)
    _same(spark, wh, clean)
    assert publish.recover(spark, wh) == []
    run_weekly(spark, wh, w2, TS3)
    _same(spark, wh, clean)


def test_killed_before_publishing(spark, tmp_root, monkeypatch):
    clean, wh, w1, w2 = _two(spark, tmp_root)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(weekly_load, "publish", dies)
        with pytest.raises(RuntimeError):
            run_weekly(spark, wh, w2, TS2)
    assert wh.read_sales(spark).count() == 2 and wh.read_product(spark).count() == 2
    assert publish.recover(spark, wh) == []  # nothing was promised
    run_weekly(spark, wh, w2, TS2)
    _same(spark, wh, clean)


def test_the_merge_is_computed_once(spark, tmp_root, monkeypatch):
    """On a second load too: what is gated and published is read from staging, not computed again."""
    raw = f"{tmp_root}/raw"
    wh = Warehouse(f"{tmp_root}/lake")
    warehouse_with_lookups(spark, wh)
    run_weekly(spark, wh, write_csv(f"{raw}/week=2023-03-05", WEEK1), TS1)
    plans = []
    real = publish.write_table

    def looks(df, path, mode, partition_by=None):
        plans.append((path, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, path, mode, partition_by)

    monkeypatch.setattr(publish, "write_table", looks)
    run_weekly(spark, wh, write_csv(f"{raw}/week=2023-03-12", WEEK2), TS2)
    (sales,) = [p for path, p in plans if path == wh.sales]
    assert "Aggregate" not in sales and "FullOuter" not in sales


def test_a_second_load_is_refused_while_one_is_at_work(spark, tmp_root, monkeypatch):
    clean, wh, w1, w2 = _two(spark, tmp_root)
    real, seen = weekly_load.publish, []

    def meets_another(*args):
        with pytest.raises(WarehouseBusy):
            run_weekly(spark, wh, w1, TS3)
        seen.append(1)
        real(*args)

    monkeypatch.setattr(weekly_load, "publish", meets_another)
    run_weekly(spark, wh, w2, TS2)
    monkeypatch.setattr(weekly_load, "publish", real)
    assert seen
    _same(spark, wh, clean)
    run_weekly(spark, wh, w2, TS3)  # released, so free again
    _same(spark, wh, clean)


@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_a_load_taken_for_dead_publishes_nothing_beside_its_successor(spark, tmp_root, monkeypatch, step):
    """Taken over before it merges, before it is staged, before its first table and before the fact."""
    clean, wh, w1, w2 = _two(spark, tmp_root)
    real, calls = lease.Lease.renew, []

    def renew(self):
        calls.append(self.number)
        if calls.count(calls[0]) == step and self.number == calls[0]:
            with monkeypatch.context() as m:
                m.setattr(lease, "EXPIRES", -1)
                run_weekly(spark, wh, w2, TS2)
        real(self)

    with monkeypatch.context() as m:
        m.setattr(lease.Lease, "renew", renew)
        with pytest.raises(LeaseLost):
            run_weekly(spark, wh, w2, TS2)
    _same(spark, wh, clean)
    run_weekly(spark, wh, w2, TS3)
    _same(spark, wh, clean)


def test_open_runs_are_finished_in_the_order_of_their_loads(spark, tmp_root, monkeypatch):
    wh, names = Warehouse(f"{tmp_root}/lake"), ["000000000010-aa", "000000000009-bb", "ffffffffffff"]
    for n in names:
        publish._note(spark, wh, n, "staged")
    monkeypatch.setattr(publish, "_apply", lambda *_: None)
    assert publish.recover(spark, wh) == ["ffffffffffff", "000000000009-bb", "000000000010-aa"]
    assert publish.recover(spark, wh) == []
