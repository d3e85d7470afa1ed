"""Language identification: averaged hashed subword embeddings and a linear softmax.

``train`` fits the model by stochastic gradient descent in numpy on a bounded
sample of labelled texts: of every language up to ``PER_LANGUAGE`` distinct texts,
fewer where there are so many languages that they would pass ``SAMPLE_TEXTS``, but
one at least; of a longer text an excerpt of ``SAMPLE_CHARS`` characters from its
first letter on, shorter where all excerpts would pass ``SAMPLE_TOTAL``.  All
values of the language column are learned, however many.  ``predict`` reads every
whole text.  A text's features are its hashed byte trigrams and four-grams,
lower-cased, all that is not a letter turned into single spaces.  Part of the
sample, not trained on, sets the softmax temperature and the score under which a
prediction counts as rejected.

Null text and text without a letter give ``und`` with score 0, rejected; so does
everything if no row has a language.  Null languages are not learned from.
Copies count once in the sample.  Repeated rows get the same answer; the
language, source and id of a row are never inputs, nor are other columns,
whatever their names.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_of_id, table

UNKNOWN = "und"
BITS, DIM = 16, 16
PER_LANGUAGE, SAMPLE_CHARS = 400, 20_000
#: Texts and characters of the sample in all.
SAMPLE_TEXTS, SAMPLE_TOTAL = 80_000, 32_000_000
#: Passes over the sample; more if a language would be seen fewer than SEEN times on average.
EPOCHS, SEEN, RATE = 6, 100, 0.5
SNIPPETS, SNIPPET_CHARS = 2, 120
#: At most this share of right predictions in the calibration part is rejected; no score above the cap is.
REJECTED_SHARE, THRESHOLD_CAP = 0.002, 0.5

# A letter, or a character that the JVM's Unicode version may not know yet.
_ANY_LETTER = r"[\p{L}\p{Cn}]"
# ASCII that is no letter becomes a space; bytes of other characters stay.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # of each hashed subword the logit for each language, or with many languages its embedding
    bias: np.ndarray
    temperature: float
    threshold: float
    weights: np.ndarray | None = None  # from embeddings to logits


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' subwords, one text after the other, and where each text's begin."""
    parts = [b" %b " % t.lower().encode("utf-8", "replace").translate(_LETTERS) for t in texts]
    ends = np.cumsum([len(x) for x in parts])
    b = np.frombuffer(b"".join(parts), np.uint8)
    kept = np.ones(len(b), bool)
    kept[1:] = (b[1:] != 32) | (b[:-1] != 32)
    kept[np.concatenate([[0], ends[:-1]])] = True  # every text keeps a space of its own
    ends = np.cumsum(kept)[ends - 1]
    b = b[kept].astype(np.uint32)
    b = np.concatenate([b, np.full(3, 32, np.uint32)])
    three = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16)
    four = three | b[3:] << np.uint32(24)
    shift = np.uint32(32 - BITS)
    h = np.empty((len(three), 2), np.uint32)
    h[:, 0] = (three * np.uint32(2654435761)) >> shift
    h[:, 1] = ((four ^ (four >> np.uint32(15))) * np.uint32(2246822519)) >> shift
    return h.reshape(-1), 2 * np.concatenate([[0], ends[:-1]]).astype(np.int64)


def _logits(model: Model, texts: list[str]) -> np.ndarray:
    h, starts = subwords(texts)
    sums = np.add.reduceat(model.table[h], starts, axis=0, dtype=np.float64)
    counts = np.diff(np.append(starts, len(h)))
    mean = sums / counts[:, None]
    return (mean if model.weights is None else mean @ model.weights) + model.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def classify(model: Model, texts: list[str | None], batch_bytes: int = 1 << 20) -> tuple[list[str], np.ndarray]:
    """Language and calibrated score of each text; long texts are read whole, in pieces."""
    out, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return out, scores
    todo, size = [], 0
    whole = [i for i, t in enumerate(texts) if has_letter(t)]
    for k, i in enumerate(whole):
        todo.append(i)
        size += len(texts[i])
        if size >= batch_bytes or k == len(whole) - 1:
            p = _softmax(_logits(model, [texts[j] for j in todo]) / model.temperature)
            for j, row in zip(todo, p):
                out[j], scores[j] = model.languages[int(row.argmax())], row.max()
            todo, size = [], 0
    return out, scores


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """The model of (text, language) rows."""
    rows = sorted((t, lang) for t, lang in rows if has_letter(t))
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([], np.zeros((1 << BITS, 1), np.float32), np.zeros(1), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = set(order[: len(rows) // 5].tolist()) if len(rows) >= 50 else set()
    trained = {lang for i, (_, lang) in enumerate(rows) if i not in held}
    for i in sorted(held):  # every language is trained on
        if rows[i][1] not in trained:
            trained.add(rows[i][1])
            held.remove(i)
    examples = []
    for i, (text, lang) in enumerate(rows):
        if i in held:
            continue
        texts = [text]
        for _ in range(SNIPPETS if len(text) > SNIPPET_CHARS else 0):
            at = int(rng.integers(0, len(text) - SNIPPET_CHARS))
            texts.append(text[at : at + SNIPPET_CHARS])
        for t in texts:
            ids, n = np.unique(subwords([t])[0], return_counts=True)
            examples.append((ids, (n / n.sum()).astype(np.float32), languages.index(lang)))
    e = rng.normal(0, 1.0 / DIM, (1 << BITS, DIM)).astype(np.float32)
    w = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    passes = max(EPOCHS, SEEN * len(languages) // len(examples))
    steps, step = passes * len(examples), 0
    for _ in range(passes):
        for k in rng.permutation(len(examples)):
            ids, share, y = examples[k]
            rate = RATE * (1 - step / steps)
            step += 1
            rows_e = e[ids]
            hidden = share @ rows_e
            x = hidden @ w + bias
            p = np.exp(x - x.max())
            p /= p.sum()
            p[y] -= 1
            back = w @ p
            w -= rate * np.outer(hidden, p)
            bias -= rate * 0.1 * p
            # a subword's own share is tiny in a long text: its embedding moves by the share's square root
            e[ids] = rows_e - rate * np.sqrt(share)[:, None] * back
    few = len(languages) <= DIM
    model = Model(languages, np.ascontiguousarray(e @ w) if few else e, bias.astype(np.float64), 1.0, 0.0, None if few else w)
    return _calibrated(model, [rows[i] for i in sorted(held)])


def _calibrated(model: Model, rows: list[tuple[str, str]]) -> Model:
    if not rows:
        return model
    x = _logits(model, [t for t, _ in rows])
    y = np.array([model.languages.index(lang) for _, lang in rows])

    def loss(t: float) -> float:
        return -np.log(np.maximum(_softmax(x / t)[np.arange(len(y)), y], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
    p = _softmax(x / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    if len(right):
        model.threshold = float(min(THRESHOLD_CAP, np.quantile(right, REJECTED_SHARE)))
    return model


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit on a bounded sample of the distinct labelled texts of ``docs``, the same whatever the partitions."""
    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where(F.col("l").isNotNull() & F.col("t").rlike(_ANY_LETTER))
    rows = rows.withColumn("h", F.xxhash64("t"))
    texts = rows.select("l", "h").distinct()  # copies are one text of their language
    counts = texts.groupBy("l").count().collect()  # a row a language
    if not counts:
        return fit([])
    spark = docs.sparkSession
    per_language = max(1, min(per_language, SAMPLE_TEXTS // len(counts)))
    # a text's place in [0, 1) by its hash; twice the texts wanted of each language and more on average, the lowest of them are taken
    place = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    most = spark.createDataFrame([(r["l"], (2.0 * per_language + 40) / r["count"]) for r in counts], "l string, most double")
    near = texts.join(F.broadcast(most), "l").where(place < F.col("most")).select("l", place.alias("p"), "h")
    lowest: dict[str, list] = {}
    for r in near.collect():
        lowest.setdefault(r["l"], []).append((r["p"], r["h"]))
    picked = [(l, h) for l, v in lowest.items() for _, h in sorted(v)[:per_language]]
    chars = max(1, min(SAMPLE_CHARS, SAMPLE_TOTAL // len(picked)))
    excerpt = F.when(F.length("t") <= chars, F.col("t")).otherwise(F.substring(F.regexp_replace("t", r"^[^\p{L}\p{Cn}]+", ""), 1, chars))
    chosen = spark.createDataFrame(picked, T.StructType([T.StructField("l", T.StringType()), T.StructField("h", T.LongType())]))
    found = rows.join(F.broadcast(chosen), ["l", "h"]).select("l", "h", excerpt.alias("x")).groupBy("l", "h").agg(F.min("x").alias("x"))
    return fit([(r["x"], r["l"]) for r in found.collect()])


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if f.name in keep]
    schema = T.StructType(
        [
            *fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = classify(shared.value, b.column(len(fields)).to_pylist())
            bad = [x == UNKNOWN or s < shared.value.threshold for x, s in zip(langs, scores)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(fields))], pa.array(langs), pa.array(scores), pa.array(bad)],
                names=schema.names,
            )

    return docs.select(*[F.col(f"`{f.name}`") for f in fields], F.col(f"`{text}`").alias("__text__")).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, text: str = "text", into: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is found and not rejected.

    ``into`` names a text column that takes the language found; the other columns, and
    all without it, are as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    to = docs.columns.index(into) if into else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = classify(shared.value, b.column(at).to_pylist())
            if to is not None:
                b = b.set_column(to, b.schema.field(to), pa.array(langs, b.schema.field(to).type))
            yield b.filter(pa.array([x != UNKNOWN and s >= shared.value.threshold for x, s in zip(langs, scores)], pa.bool_()))

    schema = T.StructType([T.StructField(f.name, f.dataType, True) if f.name == into else f for f in docs.schema.fields])
    return docs.mapInArrow(run, schema)


def held_out(folds: int = 3):
    return F.pmod(crc_of_id(), F.lit(folds)) == 1


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score (and rejected) of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    return predict(docs, model, ["doc_id", "held_out"])
