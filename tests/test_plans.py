"""Plan-shape guards: the properties the design relies on at scale."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.operators.fact import enrich_extract, merge_fact
from tillroll.sources import retail_model as RM
from tillroll.sources.tables import read_or_empty, write_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_extract_aggregates_before_shuffle_and_pushes_week_bounds(spark):
    p = plan(RM.restated_delivery(spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    # partial aggregation sits below the exchange, final above
    assert p.count("HashAggregate") >= 2 and "partial_sum" in p
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    # column pruning: only the lineitem columns the extract needs are read
    assert "l_orderkey" not in p and "l_tax" not in p


def test_merge_joins_pruned_partitions(spark, tmp_root):
    path = f"{tmp_root}/sales"
    rows = [
        (d, 1, 1, "MAT", 1, 1, decimal.Decimal("1.00"), None, None, None, None)
        for d in (20220102, 20220109, 20220116)
    ]
    write_table(spark.createDataFrame(rows, schemas.SALES), path, "partitions", "DateId")
    incoming_path = f"{tmp_root}/incoming"
    inc = spark.createDataFrame([(20220109, 1, 1, "MAT", 1, 2, decimal.Decimal("2.00"))],
                                "DateId long, ProductId long, RetailerId long, DataSource string, SKU long, UnitsSold int, SalesAmount decimal(13,2)")
    write_table(inc, incoming_path, "overwrite")
    existing = read_or_empty(spark, path, schemas.SALES).where(F.col("DateId").isin([20220109]))
    merged = merge_fact(existing, spark.read.parquet(incoming_path), "2022-01-10 00:00:00", 2, data_source="MAT")
    p = plan(merged)
    assert "PartitionFilters: [isnotnull(DateId" in p and "20220109" in p
    # the batch is reduced and shuffled once; that serves the join, and no object aggregate sorts
    assert p.count("Exchange hashpartitioning(DateId") == 2 and "FullOuter" in p
    assert "ObjectHashAggregate" not in p and "SortAggregate" not in p
    got = {r["DateId"]: (r["UnitsSold"], r["_action"]) for r in merged.collect()}
    assert got == {20220109: (2, "update")}


def test_calendar_join_is_broadcast(spark):
    from tillroll.catalog import q_resolve_keys

    p = plan(q_resolve_keys(spark, SF))
    assert "BroadcastHashJoin" in p and "PythonUDF" not in p


def test_hot_duplicate_key_is_combined_before_the_shuffle_and_rejected(spark):
    """A key holding a third of the batch: combined map-side, counted exactly, rejected by the gate."""
    from tillroll.operators import quality as Q
    from tillroll.operators.fact import SALES_GATE, SALES_TABLE

    existing = spark.createDataFrame([], schemas.SALES)
    hot = spark.range(0, 300).select(F.lit(20220109).cast("long").alias("DateId"), F.lit(7).cast("long").alias("ProductId"))
    cold = spark.range(0, 600).select(F.lit(20220109).cast("long").alias("DateId"), (F.col("id") + 100).alias("ProductId"))
    incoming = hot.unionByName(cold).select(
        "DateId", "ProductId", F.lit(1).cast("long").alias("RetailerId"), F.lit("MAT").alias("DataSource"),
        F.lit(1).cast("long").alias("SKU"), F.lit(1).alias("UnitsSold"), F.lit(1).cast("decimal(13,2)").alias("SalesAmount"),
    ).repartition(4)
    merged = merge_fact(existing, incoming, "2022-01-10 00:00:00", 1, data_source="MAT")
    p = plan(merged)
    assert "partial_count" in p and p.count("Exchange hashpartitioning(DateId") <= 2
    rows = {r["seq"]: r for r in Q.gate_report(merged, SALES_TABLE, SALES_GATE).collect()}
    assert rows[4]["violations"] == 299  # count(*) - count(DISTINCT key), as in the contract
    assert merged.count() == 601  # one row per key after the merge


def test_lookups_go_to_the_dimension(spark, tmp_root):
    """New members, orphans and taken ids filter the stored dimension where it is read: none of its rows are shuffled."""
    from tillroll.operators.dimensions import new_members, taken_ids
    from tillroll.operators.fact import orphans

    path = f"{tmp_root}/product"
    names = spark.range(0, 20_000).select(F.col("id").alias("ProductId"), F.concat(F.lit("name "), F.col("id")).alias("ProductName"), F.lit("t").alias("ProductType"))
    audit = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PRODUCT.fields[3:]]
    write_table(names.select("*", *audit), path, "overwrite")
    dim = read_or_empty(spark, path, schemas.PRODUCT)
    batch = spark.createDataFrame([("name 5", "t"), ("fresh", "t"), (None, "t")], "ProductName string, ProductType string")
    ids = spark.createDataFrame([(5,), (10**6,), (None,)], "ProductId long")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the planner would not broadcast: the count does
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for found in (new_members(batch, dim, "ProductName", "ProductId"), orphans(ids, dim, "ProductId")):
            p = plan(found)
            assert "BroadcastHashJoin" in p and "LeftSemi, BuildRight" in p
            # between the semi join and the scan of the dimension stands no shuffle
            lines = p.splitlines()
            at = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
            end = next(i for i, x in enumerate(lines) if "product]" in x)
            assert not any("Exchange hashpartitioning" in x for x in lines[at:end])
        assert {r.ProductName for r in new_members(batch, dim, "ProductName", "ProductId").collect()} == {"fresh", None}
        assert [r.ProductId for r in orphans(ids, dim, "ProductId").collect()] == [10**6]
        fresh = spark.createDataFrame([(5, "other"), (10**6, "fresh")], "ProductId long, ProductName string")
        assert [tuple(r) for r in taken_ids(fresh, dim, "ProductName", "ProductId").collect()] == [(5, None)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_mapper_repeats_are_counted_in_the_join_without_a_shuffle_of_their_own(spark):
    rows = spark.createDataFrame([(1, "R"), (1, "R"), (2, "R"), (3, "R"), (None, None)], "SKU long, Retailer string")
    mapper = spark.createDataFrame([(1, "R", "a", "t"), (1, "R", "a", "t"), (2, "R", "b", "t"), (9, "R", "c", "t"), (None, None, "d", "t")], schemas.SKU_MAPPER)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted, plain = enrich_extract(rows, mapper, "_extra"), enrich_extract(rows, mapper)
        assert plan(counted).count("Exchange hashpartitioning") == plan(plain).count("Exchange hashpartitioning")
        got = sorted((r.SKU or 0, r.Description or "", r._extra or 0) for r in counted.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(0, "", 0)] + [(1, "a", 1)] * 4 + [(2, "b", 0), (3, "", 0)]


@pytest.mark.parametrize("name", ["new_products", "new_retailers", "stamp_audit"])
def test_candidates_are_read_from_the_transactions_once(spark, tmp_root, name):
    from tillroll.catalog import QUERIES

    lines = [(k, k % 3, 1.0, 2.0, 0.0, "N", dt.datetime(1995, 1, 2) + dt.timedelta(days=9 * (k // 4))) for k in range(12)]
    names = "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_root}/lineitem.parquet")
    spark.createDataFrame([(k, f"part {k}", "type") for k in range(12)], "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_root}/part.parquet")
    spark.createDataFrame([(k, f"shop {k}") for k in range(3)], "s_suppkey long, s_name string").write.parquet(f"{tmp_root}/supplier.parquet")
    got = QUERIES[name](spark, tmp_root)
    assert not any("lineitem.parquet" in f for f in got.inputFiles())
    assert got.count() == {"new_products": 8, "new_retailers": 0, "stamp_audit": 12}[name]
