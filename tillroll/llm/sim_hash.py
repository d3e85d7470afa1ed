"""SimHash near-duplicates: vantage-point trees over 64-bit fingerprints.

``fingerprints`` gives every text its SimHash of word shingles.  ``components``
links fingerprints at most ``distance`` bits apart and returns the smallest id
that each row reaches.  Distinct fingerprints are dealt to the shards of an
upper vantage-point tree by their Hamming distances; a fingerprint whose ball
crosses a boundary also goes, as a query, to the shards beyond it, so every
close pair meets in one shard.  In a shard a tree of its own prunes by the
triangle inequality.  What leaves a shard is a spanning forest of its links, at
most one edge a fingerprint, never the pairs; edges are contracted to
components by rounds of neighbour minima, each written to the shared folder.

The upper tree is built from a bounded sample of fingerprints; it decides where
rows meet, never what is found.  Null and word-less texts have fingerprint zero
and link like any other.  Rows with equal ids or texts share their component;
rows with a null id link too, but a null is never the smallest id (a component
of null ids only has a null component id).  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_UPPER, stored, table

SHINGLE_WORDS, DISTANCE, SEED = 3, 2, 42
#: Fingerprints that a shard holds on average, that a leaf holds, and that the upper tree is built from at most.
SHARD, LEAF, SAMPLE = 8192, 64, 40_000
#: The sample takes one fingerprint in this many at least.
SAMPLE_ONE_IN = 8
_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_UPPER.lower().encode())


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """SimHash of the text's shingles of ``k`` words, repeats included."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.fromiter((digest(join(words[i : i + k]), SEED) for i in range(n)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        ones += np.unpackbits(h[a : a + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the id of each row and its fingerprint, as a signed long."""
    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), k) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["id", "fp"])

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


# -- vantage-point trees ----------------------------------------------------


def _distance(points: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def build(points: np.ndarray, leaf: int, rng: np.random.Generator):
    """A tree: the indexes of a leaf's points, or (vantage point, radius, inside, outside)."""

    def grow(at: np.ndarray):
        if len(at) <= leaf:
            return at
        vantage = points[at[rng.integers(len(at))]]
        d = _distance(points[at], vantage)
        radius = int(np.median(d))
        inside = d <= radius
        if inside.all():  # ties at the largest distance: split below it
            radius = int(d.max()) - 1
            inside = d <= radius
        if not inside.any() or inside.all():
            return at  # equal points only
        return vantage, radius, grow(at[inside]), grow(at[~inside])

    return grow(np.arange(len(points)))


def visit(tree, queries: np.ndarray, reach: int, found) -> None:
    """Call ``found(query indexes, leaf)`` for every leaf that each query's ball of radius ``reach`` can touch."""
    todo = [(tree, np.arange(len(queries)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, tuple):
            found(at, node)
            continue
        vantage, radius, inside, outside = node
        d = _distance(queries[at], vantage).astype(np.int64)
        todo.append((inside, at[d - reach <= radius]))
        todo.append((outside, at[d + reach > radius]))


def close_pairs(points: np.ndarray, queries: np.ndarray, reach: int, rng: np.random.Generator) -> Iterator[tuple]:
    """(query indexes, point indexes) at most ``reach`` bits apart, leaf by leaf."""
    out = []

    def leaf(at: np.ndarray, members: np.ndarray):
        for a in range(0, len(at), 4096):
            q, m = np.nonzero(np.bitwise_count(queries[at[a : a + 4096], None] ^ points[members][None, :]) <= reach)
            if len(q):
                out.append((at[a : a + 4096][q], members[m]))

    visit(build(points, LEAF, rng), queries, reach, leaf)
    return iter(out)


class Forest:
    """Union by smallest root over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Contract edges in whole arrays: roots hook onto smaller roots until all ends agree."""
        while True:
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while True:
            n = self.up[r]
            if (n == r).all():
                return r
            r = n


def _leaf_numbers(tree) -> list:
    leaves = []

    def number(node):
        if not isinstance(node, tuple):
            leaves.append(len(leaves))
            return leaves[-1]
        return node[0], node[1], number(node[2]), number(node[3])

    return [number(tree), leaves]


def _shard(distinct: DataFrame, tree, reach: int) -> DataFrame:
    """(shard, fp, home): each fingerprint in its own shard, and as a query wherever its ball reaches."""
    shared = distinct.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(fp), 1 << 14):
                part = fp[a : a + (1 << 14)]
                homes, away = np.empty(len(part), np.int64), []
                visit(shared.value, part, 0, lambda at, leaf: homes.__setitem__(at, leaf))
                visit(shared.value, part, reach, lambda at, leaf: away.append((at, np.full(len(at), leaf))))
                at = np.concatenate([x[0] for x in away])
                shard = np.concatenate([x[1] for x in away])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(part[at].view(np.int64)), pa.array(homes[at] == shard)], names=["shard", "fp", "home"]
                )

    return distinct.select("fp").mapInArrow(run, "shard long, fp long, home boolean")


def _forest_of_shard(reach: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["fp"], kind="stable")
        fp = pdf["fp"].to_numpy().view(np.uint64)
        home = np.nonzero(pdf["home"].to_numpy())[0]
        forest = Forest(len(fp))
        rng = np.random.default_rng(len(fp))
        for q, m in close_pairs(fp[home], fp, reach, rng):
            apart = q != home[m]
            forest.join(q[apart], home[m][apart])
        root = forest.roots(np.arange(len(fp)))
        linked = root != np.arange(len(fp))
        return pd.DataFrame({"a": fp[linked].view(np.int64), "b": fp[root[linked]].view(np.int64)})

    return run


def _contract(edges: DataFrame) -> DataFrame:
    """(fp, root): smallest node that each end of an edge reaches.

    Rounds of large star and small star: every node links its larger (then its
    smaller) neighbours to its smallest one, until a round changes nothing.
    """
    cur = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        cur = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return cur.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        before = state


def components(found: DataFrame, reach: int = DISTANCE, shard: int = SHARD) -> DataFrame:
    """(id, fp) rows with component_id, the smallest id that the row's fingerprint reaches."""
    spark = found.sparkSession
    found = stored(found, "fingerprints")
    distinct = stored(found.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    n = distinct.count()
    one_in = max(SAMPLE_ONE_IN, -(-n // SAMPLE))
    picked = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(one_in)) == 0).select("fp").orderBy("fp").limit(2 * SAMPLE).collect()
    sample = np.array([r.fp for r in picked], np.int64).view(np.uint64)
    leaf = max(1, len(sample) * shard // max(n, 1))
    tree, _ = _leaf_numbers(build(sample, leaf, np.random.default_rng(0)))
    met = _shard(distinct, tree, reach)
    edges = met.groupBy("shard").applyInPandas(_forest_of_shard(reach), "a long, b long")
    roots = _contract(edges)
    near = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = near.groupBy("root").agg(F.min("least").alias("component_id"))
    # most fingerprints stand alone: only those in links need the component's minimum
    return found.join(near.join(least, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, k: int = SHINGLE_WORDS, reach: int = DISTANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``docs``: the one with the smallest id; columns as they are.

    Of repeated rows of that id one stays.  Rows with a null id are not judged and stay.
    """
    named = docs.where(F.col(doc_id).isNotNull())
    linked = components(fingerprints(named, text, doc_id, k), reach)
    chosen = stored(linked.where("id = component_id").groupBy(F.col("id").alias("__id")).count(), "kept-ids")
    at = docs[doc_id] == F.col("__id")
    once = docs.join(chosen.where("count = 1").select("__id"), at, "left_semi")
    repeated = docs.join(chosen.where("count > 1").select("__id"), at, "left_semi").dropDuplicates([doc_id])
    return once.unionByName(repeated).unionByName(docs.where(F.col(doc_id).isNull()))


def op7_sim_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    docs = table(spark, sf_dir, "documents")
    hexa = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return components(fingerprints(docs)).select(F.col("id").alias("doc_id"), hexa.alias("fingerprint"), "component_id")
