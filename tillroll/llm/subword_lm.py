"""LM scoring: marginal likelihood of a text over a lattice of subword segmentations.

A word's probability is the sum over all its segmentations into pieces of an
existing vocabulary, found by the forward recursion in log space.  Piece weights
come from the vocabulary's own scores: the file orders its pieces, a score is the
negative place, and a piece at place r weighs 1 / (r + ``FLAT``), scaled to sum
to one together with the end of a text.  Characters without a piece are spelled
by the vocabulary's byte pieces.  What the training texts teach is one more arc
over the whole word: the model is

    P(word) = seen * c(word) / N + (1 - seen) * lattice(word)

with ``1 - seen`` the share of training tokens that occur once (the usual
estimate of the mass of unseen words).  A text's score is the sum of its words'
log10 and that of one end token.

Counts cover all training texts.  Words of a bounded head (``HEAD`` commonest)
are scored where the text is read; the others are counted per text, meet their
corpus count in a join, and only sums go back to the texts.

Null text counts as empty: one end token.  Repeated rows give repeated results,
rows with equal id and text the same one; other columns are not looked at.
Without training texts c and N are 0 and the lattice has all the mass.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_UPPER, crc_of_id, stored, table

VOCABULARY = "piece_bpe_32k.model"
FLAT = 50.0
HEAD = 50_000
#: Distinct words counted in a task before they are handed on.
FLUSH = 200_000
#: The token that ends a text: no word holds a space.
END = " "
_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_UPPER.lower().encode())
LN10 = math.log(10)


class Lattice:
    def __init__(self, vocabulary: str = VOCABULARY):
        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_unknown(i)}
        byte = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        ranked = sorted((p for p in scores if p not in byte), key=lambda p: (-scores[p], p))
        weight = {p: 1.0 / (r + FLAT) for r, p in enumerate(ranked)}
        least = 1.0 / (len(ranked) + FLAT)
        end = sum(weight.values()) * 0.001
        total = math.log(sum(weight.values()) + least * len(byte) + end)
        self.log = {p: math.log(w) - total for p, w in weight.items()}
        self.byte = math.log(least) - total
        self.end = (math.log(end) - total) / LN10
        self.longest = {}
        for p in self.log:
            self.longest[p[0]] = max(self.longest.get(p[0], 0), len(p))

    def word(self, word: str) -> float:
        """log10 of the sum over all segmentations of ▁word."""
        x = "▁" + word
        n, log, longest = len(x), self.log, self.longest
        arcs: list[list[float]] = [[] for _ in range(n + 1)]  # log weights of all paths into a place
        arcs[0].append(0.0)
        for i in range(n):
            into = arcs[i]
            top = max(into)
            here = top if len(into) == 1 else top + math.log(sum([math.exp(a - top) for a in into]))
            arcs[i] = ()
            c = x[i]
            if c not in log:
                arcs[i + 1].append(here + self.byte * len(c.encode("utf-8", "replace")))
            for j in range(i + 1, min(n, i + longest.get(c, 0)) + 1):
                w = log.get(x[i:j])
                if w is not None:
                    arcs[j].append(here + w)
        top = max(arcs[n])
        return (top + math.log(sum([math.exp(a - top) for a in arcs[n]]))) / LN10


@lru_cache(maxsize=2)
def lattice(vocabulary: str = VOCABULARY) -> Lattice:
    return Lattice(vocabulary)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_LOWER).split()


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all rows, ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.binary()).cast(pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "c"]
            )

        counts: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                counts.update(words_of(t.as_py()))
                if len(counts) >= FLUSH:
                    yield out(counts)
                    counts = Counter()
            counts[END.encode()] += b.num_rows
        yield out(counts)

    return texts.select(text).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def mixed(c: int, total: int, seen: float, spelled: float) -> float:
    """log10 of the word's probability from its count and its lattice's log10."""
    low = spelled + math.log10(1 - seen)
    if not c or seen <= 0:
        return low
    high = math.log10(seen * c / total)
    return max(low, high) + math.log10(1 + 10 ** -abs(high - low))


def score(docs: DataFrame, counts: DataFrame, keep: list[str], text: str = "text", head: int = HEAD) -> DataFrame:
    """Columns ``keep`` of ``docs`` with n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    whole = counts.agg(F.sum("c"), F.count("*"), F.sum((F.col("c") == 1).cast("long"))).first()
    total, distinct, once = (x or 0 for x in whole)
    seen = 1 - min(max(once / total, 1e-6), 0.5) if total else 0.0

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, tf, word, c) to (key, n_known, base, full): the word's part in its text's sums."""
        model = lattice()
        word = lru_cache(1 << 16)(lambda w: model.end if w == END else model.word(w))
        for b in batches:
            tf, words = b.column(1).to_pylist(), b.column(2).to_pylist()
            c = [x or 0 for x in b.column(3).to_pylist()]
            base = [n * math.log10(k + 0.5) for n, k in zip(tf, c)]
            full = [n * mixed(k, total, seen, word(w)) for n, k, w in zip(tf, c, words)]
            known = [n if k else 0 for n, k in zip(tf, c)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(full, pa.float64())],
                names=["key", "n_known", "base", "full"],
            )

    most = counts.where(F.col("word") != END).orderBy(F.desc("c"), "word").limit(head)
    ends = counts.where(F.col("word") == END).select("word", "c")
    first = spark.createDataFrame([(END,)], "word string").join(ends, "word", "left").select(F.col("word").alias("key"), F.lit(1).cast("long"), "word", "c")
    ahead = most.select(F.col("word").alias("key"), F.lit(1).cast("long"), "word", "c").unionByName(first, allowMissingColumns=True)
    parts = ahead.repartition(16, "key").mapInArrow(spell, "key string, n_known long, base double, full double").collect()
    shared = spark.sparkContext.broadcast({r.key.encode(): (r.n_known, r.base, r.full) for r in parts})

    fields = [docs.schema[c] for c in keep]
    sums = [("key", T.LongType()), ("word", T.StringType()), ("tf", T.LongType()), ("n_tokens", T.LongType())]
    sums += [("n_known", T.LongType()), ("base", T.DoubleType()), ("full", T.DoubleType())]
    read_schema = T.StructType([*fields, *[T.StructField(c, k) for c, k in sums]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row with the sums over a text's head words, and one for each other word of it."""
        near = shared.value
        end = near[END.encode()]

        def out(b: pa.RecordBatch, rows: list[list]) -> pa.RecordBatch:
            at = pa.array(rows.pop(), pa.int64())
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            cols = [pa.array(x, k) for x, k in zip(rows, kinds)]
            cols[1] = cols[1].cast(pa.string())
            return pa.RecordBatch.from_arrays([*[b.column(i).take(at) for i in range(len(fields))], *cols], names=read_schema.names)

        for b in batches:
            rows: list[list] = [[] for _ in range(8)]
            for i, (key, t) in enumerate(zip(b.column(len(fields)).to_pylist(), b.column(len(fields) + 1))):
                words = words_of(t.as_py())
                known, base, full = end
                far: list[tuple[bytes, int]] = []
                for w, f in Counter(words).items():
                    x = near.get(w)
                    if x is None:
                        far.append((w, f))
                    else:
                        known += f
                        base += f * x[1]
                        full += f * x[2]
                m = len(far)
                for col, one, more in zip(
                    rows,
                    (key, None, 0, len(words) + 1, known, base, full, i),
                    ([key] * m, [w for w, _ in far], [f for _, f in far], [0] * m, [0] * m, [0.0] * m, [0.0] * m, [None] * m),
                ):
                    col.append(one)
                    col.extend(more)
                if len(rows[0]) >= 50_000:
                    yield out(b, rows)
                    rows = [[] for _ in range(8)]
            yield out(b, rows)

    kept = [F.col(f"`{c}`") for c in keep]
    keyed = docs.select(*kept, F.monotonically_increasing_id().alias("__key"), F.col(f"`{text}`"))
    # the key is given once, in the written table, so that all that follows agrees on it
    found = stored(keyed.mapInArrow(read, read_schema), "words")
    far = found.where("word is not null").select("key", "tf", "word").join(counts, "word", "left").select("key", "tf", "word", "c")
    sums = far.mapInArrow(spell, "key long, n_known long, base double, full double").select("key", F.lit(0).cast("long").alias("n_tokens"), "n_known", "base", "full")
    near = found.where("word is null").select("key", "n_tokens", "n_known", "base", "full")
    both = near.unionByName(sums).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "full")])
    norm = math.log10(total + 0.5 * (distinct + 1))
    return found.where("word is null").select(*kept, F.col("key").alias("__key")).join(both, F.col("__key") == F.col("key")).select(
        *kept,
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * norm).alias("base_score"),
        F.col("full").alias("score"),
    )


def op5_subword_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (F.pmod(crc_of_id(), F.lit(5)) == 1).alias("held_out"))
    counts = stored(word_counts(docs.where(~F.col("held_out"))), "word-counts")
    return score(docs, counts, ["doc_id", "held_out"])
