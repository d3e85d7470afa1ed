"""Exact top-k search by a vector-approximation file.

Each vector's components (integers, ``floor(scale * x)``) are approximated by
the number of a cell, one byte at most, of an even grid over each dimension's
range.  A scan of the cells alone gives bounds on every query's inner product
with every candidate; a candidate whose upper bound lies under the kth largest
lower bound of the query can't be in its result.  The exact vectors of the
candidates that remain are read in the order of their bounds, until the kth
score is at least every bound that is left.

Queries and candidates meet in blocks: a task holds ``QUERY_BLOCK`` queries and
``CANDIDATE_BLOCK`` cells; the number of blocks follows the number of rows, and
no block is dealt by a value that rows share.

Null vectors and those with a null or non-finite component take no part.
Vectors of another length than the query's are not its candidates.  Rows with
the query's own id are not candidates; other repeated rows are, each for itself
(of equal vectors k rows of each of the k + 1 smallest ids are enough), and a repeated query row
of equal content is one query.  Ties go to the smaller
id.  Other columns are not looked at; an empty table gives no rows.  Scores must
fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

K, SCALE, CELLS = 5, 256, 64
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 16_384


def quantised(rows: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the rows that take part; v: floor(scale * x) of each component."""
    ok = F.forall(F.col("x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    doubles = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double")).alias("x"))
    return doubles.where(F.col("x").isNotNull() & F.col("vec_id").isNotNull()).where(ok).select(
        "vec_id", F.transform("x", lambda c: F.floor(c * float(scale)).cast("long")).alias("v")
    )


def grid(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and largest component of each dimension, by vector length: one row a dimension."""
    flat = rows.select(F.size("v").alias("n"), F.posexplode("v").alias("d", "c"))
    ends: dict[int, list] = {}
    for r in flat.groupBy("n", "d").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).orderBy("n", "d").collect():
        ends.setdefault(r.n, []).append((r.lo, r.hi))
    return {n: tuple(np.array(x, np.float64).T) for n, x in ends.items()}


def _width(lo: np.ndarray, hi: np.ndarray, cells: int) -> np.ndarray:
    return np.maximum(1.0, np.ceil((hi - lo + 1) / cells))


def approximate(v: pd.Series, ends: dict, cells: int) -> pd.Series:
    """Cell numbers of each vector, a byte a dimension."""
    out = np.empty(len(v), object)
    lengths = v.map(len).to_numpy()
    for n in np.unique(lengths):
        at = np.nonzero(lengths == n)[0]
        lo, hi = ends.get(int(n), (np.zeros(0), np.zeros(0)))
        x = np.array([v.iloc[i] for i in at], np.float64).reshape(len(at), n)
        number = np.clip(np.floor((x - lo) / _width(lo, hi, cells)), 0, cells - 1).astype(np.uint8)
        for i, row in zip(at, number):
            out[i] = row.tobytes()
    return pd.Series(out)


def top_k(rows: DataFrame, is_query: Column, k: int = K, cells: int = CELLS) -> DataFrame:
    """query_id, rank, vec_id and score over (vec_id, v) ``rows``; ``is_query`` over the same columns."""
    spark = rows.sparkSession
    # of equal vectors only the k + 1 smallest distinct ids can be in any result, each with k of its rows at most
    same = Window.partitionBy("v").orderBy("vec_id")
    ids = rows.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("c"))
    few = ids.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1)
    few = few.select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.col("c").cast("int")))).select("vec_id", "v")
    few = stored(few.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    queries = rows.where(is_query).distinct().select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    queries = stored(queries.withColumn("qid", F.monotonically_increasing_id()), "queries")
    ends = spark.sparkContext.broadcast(grid(few))
    n, m = few.count(), queries.count()
    qblocks, cblocks = max(1, -(-m // QUERY_BLOCK)), max(1, -(-n // CANDIDATE_BLOCK))

    cell = F.pandas_udf(lambda v: approximate(v, ends.value, cells), "binary")
    number = lambda c, blocks: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    left = few.select(
        F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))).alias("qb"), number("rid", cblocks).alias("cb"), F.col("rid").alias("at"), "vec_id",
        F.size("v").alias("n"), cell("v").alias("cell"), F.lit(None).cast("array<bigint>").alias("q"),
    )
    right = queries.select(
        number("qid", qblocks).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(cblocks - 1))).alias("cb"), F.col("qid").alias("at"),
        F.col("query_id").alias("vec_id"), F.size("q").alias("n"), F.lit(None).cast("binary").alias("cell"), "q",
    )
    schema = "qid long, query_id long, rid long, vec_id long, bound double, least double, top boolean"

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of a block pair: each query's candidates that the cells can't rule out, with bounds of their scores."""
        out = [pd.DataFrame({c: [] for c in ("qid", "query_id", "rid", "vec_id", "bound", "least", "top")})]
        asks = pdf["q"].notna()
        for length, q in pdf[asks].groupby("n"):
            c = pdf[~asks & (pdf["n"] == length)]
            if not len(c):
                continue
            lo, hi = ends.value.get(length, (np.zeros(0), np.zeros(0)))
            width = _width(lo, hi, cells)
            low = lo + np.frombuffer(b"".join(c["cell"]), np.uint8).reshape(len(c), length) * width
            ids, rids = c["vec_id"].to_numpy(), c["at"].to_numpy()
            for a in range(0, len(q), 128):
                part = q.iloc[a : a + 128]
                x = np.array(part["q"].tolist(), np.float64).reshape(len(part), length)
                corner = x @ low.T
                slack = 1e-9 * (np.abs(x) @ np.abs(low).T) + 1e-6  # sums of doubles round
                least = corner + (np.minimum(x, 0) @ (width - 1))[:, None] - slack
                most = corner + (np.maximum(x, 0) @ (width - 1))[:, None] + slack
                own = part["vec_id"].to_numpy()[:, None] == ids[None, :]
                least[own], most[own] = -np.inf, -np.inf
                place = min(k, len(ids)) - 1
                kth = -np.partition(-least, place, axis=1)[:, place]
                i, j = np.nonzero((most >= kth[:, None]) & ~own)
                out.append(
                    pd.DataFrame(
                        {
                            "qid": part["at"].to_numpy()[i],
                            "query_id": part["vec_id"].to_numpy()[i],
                            "rid": rids[j],
                            "vec_id": ids[j],
                            "bound": most[i, j],
                            "least": least[i, j],
                            "top": least[i, j] >= kth[i],
                        }
                    )
                )
        return pd.concat(out)

    scanned = stored(left.unionByName(right).groupBy("qb", "cb").applyInPandas(scan, schema), "bounds")
    # the kth largest lower bound of each query over all blocks; each block gives its k largest
    ranked = Window.partitionBy("qid").orderBy(F.desc("least"), "rid")
    sure = scanned.where("top").withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k)
    sure = sure.groupBy("qid").agg(F.min("least").alias("kth"), F.count("*").alias("found"))
    open_ = scanned.join(sure, "qid").where((F.col("found") < k) | (F.col("bound") >= F.col("kth")))
    exact = open_.select("qid", "query_id", "rid", "vec_id", "bound").join(few.select("rid", "v"), "rid")
    asked = exact.join(queries.select("qid", "q"), "qid")

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of a query: exact scores in the order of the bounds, until the kth is at least all bounds left."""
        pdf = pdf.sort_values(["bound", "vec_id"], ascending=[False, True])
        q = np.array(pdf["q"].iloc[0], np.int64)
        ids, bounds = pdf["vec_id"].to_numpy(), pdf["bound"].to_numpy()
        scores = np.empty(0, np.int64)
        for a in range(0, len(pdf), 64):
            v = np.array(pdf["v"].iloc[a : a + 64].tolist(), np.int64).reshape(-1, len(q))
            scores = np.append(scores, v @ q)
            if len(scores) >= k and a + 64 < len(pdf) and np.partition(scores, -k)[-k] > bounds[a + 64]:
                break
        best = np.lexsort((ids[: len(scores)], -scores))[:k]
        return pd.DataFrame(
            {"query_id": pdf["query_id"].iloc[0], "rank": np.arange(1, len(best) + 1, dtype=np.int32), "vec_id": ids[best], "score": scores[best]}
        )

    return asked.groupBy("qid").applyInPandas(read, "query_id long, rank int, vec_id long, score long")


def op9_va_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id and score: the 5 best of all rows for each row whose vec_id is divisible by 50."""
    rows = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(rows, F.col("vec_id") % 50 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""
