"""Shuffles and loads that keep their tasks small however large the tables are."""

import datetime as dt
import decimal
import glob
import time

import pytest
from pyspark.sql import functions as F

from fixtures import SUNDAY1, SUNDAY2, WEEK1, line, warehouse_with_lookups, write_csv
from tillroll import catalog, schemas, session
from tillroll.operators.fact import combined, date_rows, enrich_extract, merge_fact
from tillroll.plans import publish
from tillroll.plans.weekly_load import backfill
from tillroll.session import sized_shuffles
from tillroll.sources.extract import export_extract, read_export_order, read_extract
from tillroll.sources.tables import Warehouse
from tillroll.session import sized_shuffles

NUMBER, JOINED = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_shuffles_get_tasks_by_rows_and_the_settings_come_back(spark):
    before = spark.conf.get(NUMBER), spark.conf.get(JOINED)
    with sized_shuffles(spark, 100 * session.TASK_ROWS + 1):
        assert spark.conf.get(NUMBER) == "101" and spark.conf.get(JOINED) == str(session.TASK_BYTES)
        with sized_shuffles(spark, 10):  # never lowered
            assert spark.conf.get(NUMBER) == "101"
        assert spark.conf.get(NUMBER) == "101"
    assert (spark.conf.get(NUMBER), spark.conf.get(JOINED)) == before
    spark.conf.set(JOINED, "16k")
    try:
        with pytest.raises(ZeroDivisionError), sized_shuffles(spark, 0):
            assert spark.conf.get(NUMBER) == before[0] and spark.conf.get(JOINED) == str(16 << 10)
            1 / 0
        assert spark.conf.get(JOINED) == "16k"
    finally:
        spark.conf.set(JOINED, before[1])


def test_enriching_reads_the_rows_once_or_cuts_the_mapper_by_few(spark, tmp_root):
    spark.createDataFrame([(1, "R"), (1, "R"), (2, "R"), (3, "R"), (None, None), (None, "R")], "SKU long, Retailer string").write.parquet(f"{tmp_root}/rows")
    rows = spark.read.parquet(f"{tmp_root}/rows")
    held = [(1, "R", "a", "t"), (1, "R", "a", "t"), (2, "R", "b", "t"), (9, "R", "c", "t"), (None, None, "d", "t")]
    spark.createDataFrame(held, schemas.SKU_MAPPER).write.parquet(f"{tmp_root}/mapper")
    mapper = spark.read.schema(schemas.SKU_MAPPER).parquet(f"{tmp_root}/mapper")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many, few = enrich_extract(rows, mapper, "_extra"), enrich_extract(rows, mapper, "_extra", few=True)
        assert plan(many).count(f"{tmp_root}/rows") == 1
        assert "BroadcastHashJoin" in plan(few) and "LeftSemi, BuildRight" in plan(few)
        got = [sorted((r.SKU or 0, r.Description or "", r._extra or 0) for r in df.collect()) for df in (many, few)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got[0] == got[1] == [(0, "", 0)] * 2 + [(1, "a", 1)] * 4 + [(2, "b", 0), (3, "", 0)]


@pytest.fixture
def lake(spark, tmp_root):
    """Lines around the example deliveries: some only in A, some in both, some only in B."""
    day = dt.datetime(1998, 6, 1)
    lines = [(k, k % 3, 1.0 + k, 2.0, 0.1, "NR"[k % 2], day + dt.timedelta(days=9 * (k % 30))) for k in range(60)]
    names = "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_root}/lineitem.parquet")
    spark.createDataFrame([(k, f"part {k}", "type") for k in range(60)], "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_root}/part.parquet")
    spark.createDataFrame([(k, f"shop {k}") for k in range(3)], "s_suppkey long, s_name string").write.parquet(f"{tmp_root}/supplier.parquet")
    return tmp_root


def test_table_diff_loads_each_delivery_once(spark, lake, monkeypatch):
    loads, run = [], catalog.run_weekly
    monkeypatch.setattr(catalog, "run_weekly", lambda s, wh, path, ts: (loads.append(path[-10:]), run(s, wh, path, ts))[1])
    diff = catalog.QUERIES["table_diff"](spark, lake)
    assert loads == [catalog.DELIVERY_A.isoformat(), catalog.DELIVERY_B.isoformat()]
    sides = {r.side: r.n for r in diff.groupBy("side").agg(F.sum("copies").alias("n")).collect()}
    # the same from two warehouses, as the second call finds the one after A and B
    again = catalog.QUERIES["table_diff"](spark, lake)
    assert loads[2:] == [catalog.DELIVERY_A.isoformat()]
    assert sides["right_only"] > sides["left_only"] > 0
    assert sorted(map(str, diff.collect())) == sorted(map(str, again.collect()))


@pytest.mark.parametrize("name", ["fact_updates", "fact_inserts", "export_order"])
def test_results_are_made_in_sized_shuffles(spark, lake, monkeypatch, name):
    monkeypatch.setattr(session, "TASK_ROWS", 4)
    seen, write = {}, catalog.write_table

    def noted(df, path, *rest):
        seen[path.rsplit("/", 1)[-1].split("-")[0]] = int(spark.conf.get(NUMBER))
        return write(df, path, *rest)

    monkeypatch.setattr(catalog, "write_table", noted)
    assert catalog.QUERIES[name](spark, lake).count() > 0
    assert seen[{"fact_updates": "updates", "fact_inserts": "inserts", "export_order": "order"}[name]] == 15


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark):
    before = shuffle_files(spark)
    with sized_shuffles(spark, 0):
        for _ in range(3):
            spark.range(10_000).groupBy(F.col("id") % 100).count().write.format("noop").mode("overwrite").save()
        until = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < until:  # they go in the background
            time.sleep(0.1)
        assert not left
    assert spark.conf.get(session.FILES_GO, None) in (None, "false")


def test_one_delivery_is_exported_without_a_shuffle_of_its_rows(spark, tmp_root):
    rows = [(k * 7919 % 50, f"Shop {k % 7}", (SUNDAY1, SUNDAY2)[k % 2], 1, decimal.Decimal("1.00")) for k in range(50)]
    src = spark.createDataFrame(rows, "SKU long, Retailer string, `Week Ending` date, Units int, Sales decimal(13,2)").repartition(3)
    export_extract(src, f"{tmp_root}/out", dt.date(2023, 4, 2))
    assert [p.rsplit("/", 1)[-1] for p in glob.glob(f"{tmp_root}/out/*")] == ["week=2023-04-02"]
    assert len(glob.glob(f"{tmp_root}/out/*/*.csv")) == 3  # as the rows were dealt before
    assert sorted(read_extract(spark, f"{tmp_root}/out").collect()) == sorted(src.collect())
    assert read_export_order(spark, f"{tmp_root}/out").where("in_order").count() == 50


def test_dealt_sides_are_shuffled_once_and_merge_to_the_same(spark, tmp_root):
    names = "DateId long, ProductId long, RetailerId long, DataSource string, SKU long, UnitsSold int, SalesAmount decimal(13,2)"
    values = lambda n: (decimal.Decimal(n), None)[n % 5 == 0]
    stored = [(20220102 + d, k, k % 3, "MAT", k, k, values(k), None, 1, None, None) for d in (0, 7) for k in range(40)]
    spark.createDataFrame(stored, schemas.SALES).write.parquet(f"{tmp_root}/old")
    batch = [((20220102, 20220109, None)[k % 3], k, k % 3, "MAT", k, k + d, values(k), f"2022-01-{d + 10}") for k in range(20, 60) for d in (0, 1)]
    spark.createDataFrame([*batch, batch[2]], f"{names}, week string").withColumn("week", F.to_date("week")).write.parquet(f"{tmp_root}/new")
    old, new = spark.read.schema(schemas.SALES).parquet(f"{tmp_root}/old"), spark.read.parquet(f"{tmp_root}/new")
    shares = spark.createDataFrame([(20220102, 3), (20220109, 1)], "DateId long, _shares int")
    weighted = combined(new, "_n")
    args = ("2022-01-20 00:00:00", 2, "week")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with session.settings(spark, {session.ALL_KEYS: "false"}):
            merged = merge_fact(old, new.withColumn("_n", F.lit(1)), *args, weight="_n", shares=shares)
            p = merged._jdf.queryExecution().executedPlan().toString()
            assert p.count("Exchange hashpartitioning(") == 2 and p.count("Exchange hashpartitioning(DateId") == 2
            got = [sorted(map(str, m.collect())) for m in (merged, merge_fact(old, weighted, *args, weight="_n", shares=shares), merge_fact(old, new, *args))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got[0] == got[1] == got[2] and len(got[0]) == 107
    assert date_rows(weighted, "_n") == date_rows(new) == {20220102: 27, 20220109: 26}


def test_publishing_shuffles_no_rows_and_a_replayed_backfill_keeps_no_copy_of_its_rows(spark, tmp_root, monkeypatch):
    wh, plans, real = Warehouse(f"{tmp_root}/lake"), [], publish.write_table
    warehouse_with_lookups(spark, wh)
    write_csv(f"{tmp_root}/raw/week=2023-03-05", WEEK1)
    write_csv(f"{tmp_root}/raw/week=2023-03-12", [line(52, "Halden", SUNDAY1, 99.0, "1.00")])

    def looks(df, path, *rest):
        plans.append((path, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, path, *rest)

    monkeypatch.setattr(publish, "write_table", looks)
    for day in (6, 7):
        backfill(spark, wh, f"{tmp_root}/raw", f"2023-03-{day:02d} 06:00:00")
    (sales,) = [p for path, p in plans if path == wh.sales]
    assert "Repartition" not in sales and "Rebalance" not in sales
    copies = glob.glob(f"{wh.stage('*')}/enriched")
    assert len(copies) == 2 and all(spark.read.parquet(c).isEmpty() for c in copies)
    assert wh.read_sales(spark).count() == 2
