"""Toxicity: a character n-gram linear classifier over naive Bayes log-count ratios.

A text's features are the distinct character n-grams (``LOWEST`` to ``HIGHEST``
characters, word ends included, and whole words) of its lower-cased words, hashed
to ``1 << BITS`` numbers.  Training has three steps:

* Spark counts, over all labelled rows, how many texts of each class have each
  n-gram; the log ratio of the two smoothed shares is the n-gram's scale, and the
  ``FEATURES`` n-grams that tell the classes apart best (by G squared) are kept;
* logistic regression on the scaled features is fitted in numpy on a bounded
  sample: the ``PER_CLASS`` distinct texts of each class that come first by hash;
* each half of the sample is scored by a model of the other half; a line through
  these log odds turns a sum into a probability, moved so that the best separating
  sum gets ``CUT``.

``score`` reads whole texts.  Null, empty and wordless texts have no features and
all get the score of an empty sum.  Without rows of both classes every
text scores 0.  Ids with several label rows count as toxic if one of them says so;
null labels and null ids are not learned from.  Copies count once in the sample,
each in the counts.  Repeated rows get the same score; columns other than the
named ones are not looked at.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_of_id, stored, table

LOWEST, HIGHEST, BITS = 3, 6, 22
FEATURES, PER_CLASS = 1 << 14, 4000
PENALTY, CUT = 1e-4, 0.7
#: Labels (an id and a number each) that are broadcast, at most.
SENT_LABELS = 2_000_000
_WORD = re.compile(r"[^\W\d_]+")
#: Texts are read in blocks of about so many characters; a task holds about so many words.
BLOCK, KNOWN = 1 << 22, 500_000


@dataclass
class Model:
    grams: np.ndarray  # numbers of the features, ascending
    weights: np.ndarray  # weight times log-count ratio of each
    bias: float
    scale: float = 1.0
    shift: float = 0.0


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the words, and the place of each n-gram's word."""
    text = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    left = np.repeat(start[1:], size) - np.arange(len(c))  # characters from here to the word's end
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    p, mix, shift = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
    found, of = [], []
    h = c.copy()
    for n in range(2, HIGHEST + 1):
        h = h[:-1] * p + c[n - 1 :]  # of the n characters from each place on
        if n >= LOWEST:
            at = np.flatnonzero(left[: len(h)] >= n)
            found.append((((h[at] + np.uint64(n)) * mix) >> shift).astype(np.int32))
            of.append(owner[at])
    # whole words: a sum over places, told apart from n-grams by another factor
    place = np.arange(len(c), dtype=np.int64) - np.repeat(start[:-1], size)
    spread = (c + (2 * place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) * mix
    spread ^= spread >> np.uint64(29)
    sums = np.add.reduceat(spread * np.uint64(0xBF58476D1CE4E5B9), start[:-1])
    found.append(((sums * mix) >> shift).astype(np.int32))
    of.append(np.arange(len(words), dtype=np.int32))
    return np.concatenate(found), np.concatenate(of)


class Reader:
    """Distinct n-grams of texts: as numbers, or as places in the ascending ``wanted``.

    Words met before are looked up; what is known of them goes when ``KNOWN`` words are held.
    """

    def __init__(self, wanted: np.ndarray | None = None):
        self.place = None
        if wanted is not None:
            self.place = np.full(1 << BITS, -1, np.int32)
            self.place[wanted] = np.arange(len(wanted), dtype=np.int32)
        self.seen = np.zeros((1 << BITS) if wanted is None else max(len(wanted), 1), np.int32)
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.grams, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        grams, of = word_grams(words)
        if self.place is not None:
            grams = self.place[grams]
            of, grams = of[grams >= 0], grams[grams >= 0]
        self.grams = np.concatenate([self.grams, grams[np.argsort(of, kind="stable")]])
        ends = self.starts[-1] + np.cumsum(np.bincount(of, minlength=len(words)))
        self.starts = np.concatenate([self.starts, ends])

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """One array a text; texts are taken in blocks of about ``BLOCK`` characters."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < BLOCK):
                size += len(texts[end] or "")
                end += 1
            if self.place is None or len(self.codes) > KNOWN:
                self._forget()
            codes, before = self.codes, len(self.codes)
            docs = [[codes.setdefault(w, len(codes)) for w in set(_WORD.findall((t or "").lower()))] for t in texts[at:end]]
            if len(codes) > before:
                self._learn(list(islice(codes, before, None)))
            for words in docs:
                yield self._distinct(np.array(words, np.int64))
            at = end

    def _distinct(self, words: np.ndarray) -> np.ndarray:
        n = self.starts[words + 1] - self.starts[words]
        total = int(n.sum())
        if not total:
            return np.zeros(0, np.int32)
        g = self.grams[np.repeat(self.starts[words + 1] - np.cumsum(n), n) + np.arange(total)]
        order = np.arange(total, dtype=np.int32)
        self.seen[g] = order  # the last place of each number stands for it
        return g[self.seen[g] == order]


def log_ratio(pos, neg, n_pos: int, n_neg: int):
    """Log of the smoothed shares of texts with an n-gram, toxic to other."""
    return np.log((pos + 1.0) / (n_pos + 2.0)) - np.log((neg + 1.0) / (n_neg + 2.0))


def _minimum(f, x: np.ndarray, steps: int = 80, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, shares = -grad, []
        for s, y in reversed(past):
            shares.append((s @ d) / (y @ s))
            d = d - shares[-1] * y
        d = d * ((past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / (np.linalg.norm(grad) + 1e-12))
        for (s, y), a in zip(past, reversed(shares)):
            d = d + (a - (y @ d) / (y @ s)) * s
        step, slope = 1.0, grad @ d
        while step > 1e-8:
            new, new_grad = f(x + step * d)
            if new <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            return x
        s, y = step * d, new_grad - grad
        if y @ s > 1e-12:
            past = [*past, (s, y)][-memory:]
        gain, x, value, grad = value - new, x + s, new, new_grad
        if gain < 1e-7 * abs(value):
            break
    return x


def _logistic(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Weights (times their ratios) and bias; both classes weigh the same."""
    owner, idx = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.zeros(0, np.int32)])
    value = ratio[idx]
    share = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))

    def loss(wb):
        w, b = wb[:-1], wb[-1]
        z = np.bincount(owner, value * w[idx], len(rows)) + b
        g = share * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        total = (share * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * penalty * (w @ w)
        return total, np.append(np.bincount(idx, value * g[owner], len(ratio)) + penalty * w, g.sum())

    wb = _minimum(loss, np.zeros(len(ratio) + 1))
    return wb[:-1] * ratio, float(wb[-1])


def fit(grams: np.ndarray, ratio: np.ndarray, rows: list[np.ndarray], y: np.ndarray, penalty: float = PENALTY) -> Model:
    """The model of a sample: ``rows`` hold places in ``grams``."""
    y = y.astype(np.float64)
    w, b = _logistic(rows, y, ratio, penalty)
    half = np.arange(len(rows)) % 2
    if min((half == h).sum() and np.unique(y[half == h]).size for h in (0, 1)) < 2:
        return Model(grams, w, b)
    z = np.zeros(len(rows))
    for h in (0, 1):
        wh, bh = _logistic([r for r, k in zip(rows, half) if k != h], y[half != h], ratio, penalty)
        for i in np.flatnonzero(half == h):
            z[i] = wh[rows[i]].sum() + bh
    # probability of a sum: a line through log odds
    spread = max(z.std(), 1e-6)

    def loss(ab):
        t = ab[0] * z / spread + ab[1]
        g = 1 / (1 + np.exp(-np.clip(t, -50, 50))) - y
        return (np.logaddexp(0, t) - y * t).mean() + 1e-4 * ab[0] ** 2, np.array([(g * z / spread).mean() + 2e-4 * ab[0], g.mean()])

    scale = max(_minimum(loss, np.array([1.0, 0.0]))[0] / spread, 1e-3)
    # the sum that separates best: most toxic texts found less twice the others taken for them
    order = np.argsort(-z, kind="stable")
    gain = np.cumsum(np.where(y[order] == 1, 1.0, -2.0))
    k = int(gain.argmax())
    best = (z[order[k]] + z[order[min(k + 1, len(z) - 1)]]) / 2
    return Model(grams, w, b, scale, float(np.log(CUT / (1 - CUT)) - scale * best))


def scores(model: Model, texts: list[str | None], reader: Reader | None = None) -> np.ndarray:
    if not len(model.grams):
        return np.zeros(len(texts))
    z = np.array([model.weights[g].sum() for g in (reader or Reader(model.grams))(texts)]) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.scale * z + model.shift, -50, 50)))


def gram_counts(rows: DataFrame) -> DataFrame:
    """(g, pos, neg) of rows (x text, y label): texts of each class with the n-gram; g = -1 counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals, read = np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int64), Reader()
        for b in batches:
            y = b.column(1).to_pylist()
            for k, g in enumerate(read(b.column(0).to_pylist())):
                counts[y[k], g] += 1
                totals[y[k]] += 1
        some = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(some), 1 << 18):
            part = some[at : at + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[1, part], pa.int64()), pa.array(counts[0, part], pa.int64())], names=["g", "pos", "neg"])
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([totals[1]]), pa.array([totals[0]])], names=["g", "pos", "neg"])

    return rows.select("x", "y").mapInArrow(run, "g long, pos long, neg long").groupBy("g").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _g_squared(n_pos: int, n_neg: int):
    """How much the class of a text depends on having the n-gram, of columns pos and neg."""

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    share, total = (pos + neg) / F.lit(float(n_pos + n_neg)), F.lit(0.0)
    for seen, n in ((pos, n_pos), (neg, n_neg)):
        total = total + part(seen, share * n) + part(F.lit(float(n)) - seen, (F.lit(1.0) - share) * n)
    return total


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Fit on the rows of ``docs`` that ``labels`` (id, label 0 or 1) marks."""
    empty = Model(np.zeros(0, np.int32), np.zeros(0), 0.0)
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(f"`{doc_id}`").alias("i")).agg(F.max(label).cast("int").alias("y"))
    marks = stored(marks.where("i is not null"), "labels")
    # few labels go to the texts; more than that, and texts and labels meet in a shuffle
    marks = F.broadcast(marks) if marks.count() <= SENT_LABELS else marks
    rows = docs.select(F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").alias("x")).where("x is not null").join(marks, "i").select("x", "y")
    rows = stored(rows, "labelled")  # texts are joined to their labels once
    counts = stored(gram_counts(rows), "grams")
    totals = counts.where("g = -1").first()
    if totals is None or not totals["pos"] or not totals["neg"]:
        return empty
    n_pos, n_neg = totals["pos"], totals["neg"]
    kept = counts.where("g >= 0 and pos + neg > 1").orderBy(_g_squared(n_pos, n_neg).desc(), "g").limit(FEATURES).collect()
    kept = sorted((r["g"], r["pos"], r["neg"]) for r in kept)
    if not kept:
        return empty
    grams = np.array([r[0] for r in kept], np.int32)
    ratio = log_ratio(np.array([r[1] for r in kept]), np.array([r[2] for r in kept]), n_pos, n_neg)

    # a bounded sample of distinct texts, first by hash; only places of features leave the tasks
    hashed = rows.withColumn("h", F.xxhash64("x"))
    picked = [
        (y, r["h"]) for y in (0, 1) for r in hashed.where(F.col("y") == y).select("h").distinct().orderBy("h").limit(per_class).collect()
    ]
    chosen = docs.sparkSession.createDataFrame(picked, "y int, h long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(grams)
        for b in batches:
            found = [np.sort(g).astype("<i4").tobytes() for g in read(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], names=["y", "h", "g"])

    sample = hashed.join(F.broadcast(chosen), ["y", "h"]).select("y", "h", "x").mapInArrow(run, "y int, h long, g binary")
    found = sorted((r["h"], r["y"], bytes(r["g"])) for r in sample.groupBy("y", "h").agg(F.min("g").alias("g")).collect())
    return fit(grams, ratio, [np.frombuffer(g, "<i4") for _, _, g in found], np.array([y for _, y, _ in found]))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with score (0 to 1) and predicted (1 from ``CUT`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [docs.schema[k] for k in keep]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        read = Reader(model.grams)
        for b in batches:
            found = scores(model, b.column(len(fields)).to_pylist(), read)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(fields))], pa.array(found), pa.array((found >= CUT).astype(np.int32))], names=schema.names
            )

    return docs.select(*[F.col(f"`{f.name}`") for f in fields], F.col(f"`{text}`").alias("__text__")).mapInArrow(run, schema)


def held_out(folds: int = 3):
    return F.pmod(crc_of_id(), F.lit(folds)) == 1


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    model = train(docs.where(~F.col("held_out")), labels)
    return score(docs, model, ["doc_id", "held_out"])
