import duckdb
import pytest
from fixtures import LEMON, MAPPER_ROWS, OAT
from pyspark.sql import functions as F

from tillroll.functions.keys import KEY_SUFFIX, key_of, member_key, surrogate_key, wide_key
from tillroll.operators.dimensions import settle_ids
from tillroll.oracle_hash import spark_hash_sql, surrogate_key_sql, wide_key_sql


def test_ids_are_hashes_of_names(spark):
    df = spark.createDataFrame([(n,) for n in (LEMON, OAT, "Halden", None)], "n string")
    got = df.select("n", surrogate_key("n").alias("k"), F.hash(F.concat("n", F.lit(KEY_SUFFIX))).alias("h"), member_key("n").alias("m")).collect()
    for r in got:
        assert r.k == r.h + 2147483647 and r.k >= 0
        assert (r.m is None) == (r.n is None)


def test_duckdb_hash_equals_spark(spark):
    names = ["", "a", "ab", "abc", "abcd", "abcde", "héllo wörld", "日本語", "Supplier#000000001", None]
    sp = {r[0]: (r[1], r[2]) for r in spark.createDataFrame([(n,) for n in names], "n string")
          .select("n", F.hash("n"), surrogate_key("n")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(n VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(n,) for n in names])
    dd = {r[0]: (r[1], r[2]) for r in con.execute(f"SELECT n, {spark_hash_sql('n')}, {surrogate_key_sql('n')} FROM t").fetchall()}
    assert sp == dd


@pytest.mark.parametrize("bits", [63, 32, 8])
def test_wide_keys_have_their_bits(spark, bits):
    keys = [r.k for r in spark.range(2000).select(key_of(F.concat(F.lit("n"), "id"), bits).alias("k")).collect()]
    assert min(keys) >= 0 and max(keys) < 2**bits
    assert len(set(keys)) == {63: 2000, 32: 2000, 8: 256}[bits]


def test_duckdb_wide_key_equals_spark(spark):
    names = ["", "a", "Ostrava Foods", "héllo", "日本語" * 9]
    sp = {r.n: r.k for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", wide_key("n").alias("k")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(n VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(n,) for n in names])
    assert sp == dict(con.execute(f"SELECT n, {wide_key_sql('n')} FROM t").fetchall())


def test_many_names_have_ids_of_their_own(spark):
    """Ten times the names at which 32-bit ids are likely to collide."""
    names = spark.range(800_000).select(F.concat(F.lit("part #"), "id").alias("n"))
    assert names.select(wide_key("n").alias("k")).distinct().count() == 800_000
    assert names.select(surrogate_key("n").alias("k")).distinct().count() < 800_000


def _keep(spark, tmp_root):
    def keep(df, label):
        df.write.parquet(f"{tmp_root}/{label}")
        return spark.read.schema(df.schema).parquet(f"{tmp_root}/{label}")

    return keep


def test_collisions_move_as_few_as_they_must(spark, tmp_root):
    dim = spark.createDataFrame([(5, "old", None, None, None, None, None)], "ProductId long, ProductName string, ProductType string, a int, b int, c int, d int")
    plain = {r.n: r.k for r in spark.range(200).select(F.concat(F.lit("m"), "id").alias("n")).select("n", key_of("n", 10).alias("k")).collect()}
    fresh = spark.createDataFrame([(k, n, None, None, None, None, None) for n, k in plain.items()], dim.schema)
    got, moved = settle_ids(fresh, dim, "ProductName", "ProductId", 10, _keep(spark, tmp_root))
    moved = {r.ProductName: r.ProductId for r in moved.collect()}
    ids = {r.ProductName: r.ProductId for r in got.collect()}
    assert len(set(ids.values())) == 200 and 5 not in ids.values()
    assert {n for n in ids if ids[n] != plain[n]} <= set(moved)
    assert len(moved) < 60 and all(ids[n] == i for n, i in moved.items())


def test_many_collisions_settle_by_joins(spark, tmp_root, monkeypatch):
    """A tenth of 40,000 names collide at 18 bits, with each other and with stored ones; nothing is collected."""
    names = spark.range(40_000).select(F.concat(F.lit("name "), "id").alias("ProductName"))
    keyed = names.select(key_of("ProductName", 18).alias("ProductId"), "ProductName")
    old = spark.range(10_000).select(F.col("id").alias("ProductId"), F.concat(F.lit("stored "), "id").alias("ProductName"))
    with monkeypatch.context() as m:
        m.setattr(type(names), "collect", lambda self: pytest.fail("collected"))
        got, moved = settle_ids(keyed, old, "ProductName", "ProductId", 18, _keep(spark, tmp_root))
    assert got.select("ProductId").distinct().count() == got.count() == 40_000
    assert got.join(old, "ProductId").isEmpty()
    plain = got.join(keyed.withColumnRenamed("ProductId", "plain"), "ProductName").where("ProductId <> plain")
    assert moved.count() >= plain.count() > 2_000
    assert plain.join(moved, ["ProductName", "ProductId"], "left_anti").isEmpty()


def test_no_collision_changes_nothing(spark, tmp_root):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "ProductId long, ProductName string")
    got, moved = settle_ids(rows, rows.limit(0), "ProductName", "ProductId", 10, _keep(spark, tmp_root))
    assert moved is None and got.columns == rows.columns and got.count() == 4
