import math

import duckdb
import pytest

from tillroll.llm import va_search as S

from .helpers import rng

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, qid string, v string"


def rows(n=400, dim=8, seed=1):
    r = rng(seed)
    out = [(i, [r.gauss(0, 0.4) for _ in range(dim)]) for i in range(n)]
    out += [(n + i, list(out[3][1])) for i in range(60)]  # a group of copies
    out += [(1000, None), (1050, [None] + [0.1] * (dim - 1)), (1100, [math.nan] * dim), (1150, [math.inf] * dim)]
    out += [(1200, [0.5] * 3), (1201, [0.25] * 3), (1250, []), (out[7]), (50, list(out[50][1])), (None, [0.1] * dim)]
    out += [(1300, [0.0] * dim), (1301, [100.0] * dim)]
    return [(i, v, None, "a", "b", "c") for i, v in out]


def slow(data, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in ok if i != q and len(v) == len(x))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("blocks, cells", [((1024, 16_384), 64), ((3, 37), 4), ((2, 1000), 256)])
def test_query_equals_brute_force(spark, tmp_root, monkeypatch, blocks, cells):
    monkeypatch.setattr(S, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(S, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(S.top_k, "__defaults__", (S.K, cells))
    # floats as the table holds them
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    frame.write.parquet(f"{tmp_root}/embeddings.parquet")
    data = [tuple(r) for r in frame.collect()]
    assert sorted(map(tuple, S.op9_va_search(spark, tmp_root).collect())) == slow(data)


def test_sql_agrees(spark, tmp_root):
    r = rng(2)
    data = [(i, [r.gauss(0, 0.2) for _ in range(16)], None, "a", "b", "c") for i in range(300)]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_root}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_root}/embeddings.parquet/*.parquet'")
    assert sorted(map(tuple, S.op9_va_search(spark, tmp_root).collect())) == sorted(con.execute(S.ORACLE).fetchall())


def test_empty_table(spark, tmp_root):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_root}/embeddings.parquet")
    assert S.op9_va_search(spark, tmp_root).count() == 0


def test_repeated_query_rows_do_not_push_out_equal_vectors(spark, tmp_root):
    same, lower = [0.5, 0.25], [0.25, 0.25]
    data = [(i, v, None, "a", "b", "c") for i, v in [(0, same)] * 4 + [(i, same) for i in (1, 2, 3, 4, 5, 7)] + [(8, lower)] * 2 + [(50, lower)] * 7 + [(51, lower)] * 7]
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{tmp_root}/embeddings.parquet")
    got = sorted(map(tuple, S.op9_va_search(spark, tmp_root).collect()))
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 3, 4, 5]
    assert got == slow(data)
