"""Phrase collocations by Toivonen's sampling: propose on a sample, count exactly, expand until closed.

A phrase is a run of one to ``LONGEST`` words inside a piece of text (pieces end at
sentence and clause marks and line ends), counted per language.  A phrase can only
be frequent if the two phrases left by taking off its first or its last word are.

* **Sample**: documents picked by a hash are mined level by level with a lowered
  bound.  What is frequent there is the set of proposed phrases.
* **Bound pass**: the proposed phrases and their negative border (phrases whose
  two shorter parts are proposed; words have no parts, so all words) are counted
  over all documents under their 64-bit hashes.  A hash counts no less than any of
  its phrases, so only phrases with a large enough hash can be frequent.
* **Exact pass**: these are counted by their words, over all documents.  Those that
  were not proposed are border failures; the same pass expands them until closed: it
  also counts each phrase that was neither proposed nor on the border and whose parts
  are counted in this pass.  So every frequent phrase is counted, by its words,
  whatever the sample held.

Tasks ask bit filters whether a phrase is in a set.  Their size is bounded
(``FILTER_BITS``); a wrong yes only has one more phrase counted, and a fuller filter
more of them, never fewer.  Nothing else of a set reaches a task or the driver.

``collocations`` scores frequent phrases of two words and more by their weakest cut
and drops those that a longer one holds as often.  Null texts count as empty, null
languages as ``und``; repeated rows count each; a text without words adds nothing;
an empty table gives no rows; ties go to the smaller cut and the smaller phrase in
bytes; columns other than the two named ones are not looked at; texts are whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ASCII_UPPER, stored, table

LONGEST, LEAST, TOP = 5, 100, 2000
#: Documents of the sample: one in so many; its bound is this share of the one expected there.
SAMPLE_ONE_IN, LOWERED = 8, 0.5
#: A filter has a bit for so many characters of the corpus, within these bounds (128 MB at most).
FILTER_BITS, CHARS_A_BIT, PROBES = (1 << 16, 1 << 30), 16, 3
UNKNOWN = "und"
#: Characters that a task counts at a time.
BLOCK = 1 << 22

# Marks that end a piece, and white space between words.
_ENDS, _SPACE = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
#: 0xFF is in no UTF-8 text.
_END = b"\xff"
_SIGNS = bytes(
    _END[0] if c in _ENDS else 32 if c in _SPACE else c + 32 if chr(c) in ASCII_UPPER else c for c in range(256)
)
_PROBES = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64)) for k in range(PROBES)]
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Filter:
    """A set of phrases, by their hashes; ``bits`` is a power of two, or 0 for the empty set."""

    cells: np.ndarray  # bytes of eight bits each

    @property
    def bits(self) -> int:
        return 8 * len(self.cells)

    @staticmethod
    def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
        shift = np.uint64(64 - (bits.bit_length() - 1))
        return [(h * p) >> shift for p in _PROBES]

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.full(len(h), bool(self.bits))
        if self.bits:
            for p in self.places(h, self.bits):
                found &= (self.cells[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


_COUNTED = "lang string, k int, phrase string, h long, f long"
EMPTY = Filter(np.zeros(0, np.uint8))


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h * _STEP) ^ word
    h ^= h >> np.uint64(29)
    return h * _SPREAD


def walk(texts: list[str], lang: str, known: Filter, bound: Filter | None = None, longest: int = LONGEST):
    """(k, hashes, counts, phrases) for each length k of what a pass counts, after the number of words as k = 0.
    ``phrases()`` gives the words.

    Without ``bound``: what ``known`` admits, that is proposed phrases and their border.
    With it: of these, those in ``bound``, and what they admit beyond the border.
    """
    raw = _END.join(t.encode("utf-8", "surrogatepass") for t in texts).translate(_SIGNS)
    words = (raw.replace(_END, b" \xff ") + b" \xff").split()
    codes: dict[bytes, int] = {_END: 0}
    one = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    n_words = len(codes)
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    word_hash = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in codes), np.uint64, n_words)

    at = np.flatnonzero(one)  # where phrases of k words begin
    code = one[at]  # the phrase that begins there
    hashes, size = word_hash, n_words
    bordered = np.ones(len(at), bool)  # counted in the bound pass
    yield 0, np.zeros(1, np.uint64), np.array([len(at)]), lambda: [""]
    for k in range(1, longest + 1):
        n = np.bincount(code, minlength=size)
        first = np.zeros(size, np.int64)
        first[code] = at
        counted = n > 0
        if bound is not None:
            beyond = np.zeros(size, bool)
            beyond[code[~bordered]] = True
            counted &= bound.has(hashes) | beyond
        some = np.flatnonzero(counted)
        yield k, hashes[some], n[some], lambda i=first[some], k=k: [b" ".join(words[j : j + k]).decode("utf-8", "surrogatepass") for j in i.tolist()]
        if k == longest:
            return
        inside = known.has(hashes)
        go = np.zeros(len(one) + 1, bool)
        go[at] = (counted if bound is not None else inside)[code]
        near = np.zeros(len(one) + 1, bool)
        near[at] = bordered & inside[code]
        number = np.zeros(len(one), np.int64)
        number[at] = code
        at = np.flatnonzero(go[:-1] & go[1:])
        bordered = near[at] & near[at + 1]
        key, code = np.unique(number[at] * n_words + one[at + k], return_inverse=True)
        hashes, size = _mixed(hashes[key // n_words], word_hash[key % n_words]), len(key)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """(language, texts): about ``BLOCK`` characters at a time, by language."""
    for batch in batches:
        by: dict[str, list[str]] = {}
        size, last = 0, batch.num_rows - 1
        for i, (t, lang) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            by.setdefault(lang, []).append(t)
            size += len(t)
            if size >= BLOCK or i == last:
                yield from by.items()
                by, size = {}, 0


def hash_sums(docs: DataFrame, known: Filter) -> DataFrame:
    """(h, f): occurrences, by hash, of the phrases of ``docs`` (x text, l language) that ``known`` admits."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _blocks(batches):
            for k, h, n, _ in walk(texts, lang, sent.value):
                if k:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "f"])

    return docs.select("x", "l").mapInArrow(run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def count_phrases(docs: DataFrame, known: Filter, bound: Filter | None = None, only: int | None = None) -> DataFrame:
    """(lang, k, phrase, h, f) of what ``walk`` counts, of length ``only`` if given; k = 0: all words."""
    sent = docs.sparkSession.sparkContext.broadcast((known, bound))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bound = sent.value
        for lang, texts in _blocks(batches):
            for k, h, n, phrases in walk(texts, lang, known, bound, only or LONGEST):
                if only in (None, k):
                    yield _rows(lang, k, phrases(), h, n)

    return docs.select("x", "l").mapInArrow(run, _COUNTED).groupBy("lang", "k", "phrase", "h").agg(F.sum("f").alias("f"))


def _rows(lang: str, k: int, phrases: list[str], h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    size = len(phrases)
    cells = [pa.array([lang] * size, pa.string()), pa.array(np.full(size, k, np.int32)), pa.array(phrases, pa.string()), pa.array(h.view(np.int64)), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(cells, names=["lang", "k", "phrase", "h", "f"])


def _with(known: Filter, phrases: DataFrame, bits: int) -> Filter:
    """``known`` and the phrases (h) as well; the driver gets the filter's cells, never the phrases."""
    part = 1 << 15

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.unique(np.concatenate(Filter.places(b.column(0).to_numpy().view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64))], names=["p"])

    def cells(group: pa.Table) -> pa.Table:
        on = np.zeros(part, np.uint8)
        on[group["p"].to_numpy() % part] = 1
        return pa.table({"s": group["s"].slice(0, 1), "c": pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())})

    found = phrases.select("h").mapInArrow(places, "p long").distinct().withColumn("s", F.shiftright("p", 15))
    out = known.cells.copy() if known.bits else np.zeros(bits // 8, np.uint8)
    for r in found.groupBy("s").applyInArrow(cells, "s long, c binary").collect():
        at = r["s"] * (part // 8)
        out[at : at + part // 8] |= np.frombuffer(r["c"], np.uint8)
    return Filter(out)


def propose(sample: DataFrame, least: int, bits: int) -> Filter:
    """The phrases of ``sample`` that occur ``least`` times or more, level by level."""
    known = EMPTY
    for k in range(1, LONGEST):
        found = stored(count_phrases(sample, known, only=k).where((F.col("k") == k) & (F.col("f") >= least)), "phrase-sample")
        known = _with(known, found, bits)
        if found.isEmpty():
            break
    return known


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, one_in: int = SAMPLE_ONE_IN, lowered: float = LOWERED
) -> DataFrame:
    """(lang, k, phrase, f) of all phrases that occur ``least`` times or more; k = 0 with an empty phrase: all words of the language."""
    whole = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("x"), F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("l"))
    chars = whole.agg(F.sum(F.length("x").cast("long"))).first()[0] or 0
    bits = 1 << (min(max(chars // CHARS_A_BIT, FILTER_BITS[0]), FILTER_BITS[1]) - 1).bit_length()
    sample = whole.where(F.pmod(F.xxhash64("x", "l"), F.lit(one_in)) == 0)
    known = propose(sample, max(2, int(lowered * least / one_in)), bits)
    bound = _with(EMPTY, stored(hash_sums(whole, known).where(F.col("f") >= least).select("h"), "phrase-bound"), bits)
    counted = count_phrases(whole, known, bound).where((F.col("f") >= least) | (F.col("k") == 0))
    return stored(counted.select("lang", "k", "phrase", "f"), "phrases")


def cut_scores(phrases: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the weakest cut of each phrase; ``frequent`` has the counts of the parts."""
    words = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ").alias("rest"),
    )
    parts = frequent.where("k > 0").select("lang", "phrase", "f")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    totals = frequent.where("k = 0").select("lang", F.col("f").alias("n"))
    found = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    score = F.expr(
        "(cast(a * 1000 as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    low = found.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("s"))
    return low.groupBy("lang", "phrase", "a", "n").agg(F.min("s").alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")


def maximal(phrases: DataFrame, percent: int = 100) -> DataFrame:
    """``phrases`` without those that a longer one holds with ``percent`` of their count or more.

    Counts fall with length, so looking at phrases of one more word is enough.
    """
    words = F.split("phrase", " ")
    k = F.size(words)
    longer = phrases.where("k > 2").select(
        "lang",
        "f",
        F.explode(F.array(F.array_join(F.slice(words, F.lit(1), k - 1), " "), F.array_join(F.slice(words, F.lit(2), k - 1), " "))).alias("phrase"),
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("held"))
    kept = phrases.join(most, ["lang", "phrase"], "left")
    return kept.where(F.col("held").isNull() | (100 * F.col("held") < percent * F.col("f"))).select(*phrases.columns)


def ranked(scored: DataFrame, top: int = TOP, salts: int = 64) -> DataFrame:
    """The first ``top`` of each language: first within each of ``salts`` parts of it, then of what these leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    part = scored.withColumn("_p", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("_p") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return part.withColumn("rank", rank).where(F.col("rank") <= top).drop("_p")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two words and more of each language."""
    frequent = frequent_phrases(docs, text, lang, least)
    kept = maximal(frequent.where("k > 1"))
    return ranked(cut_scores(kept, frequent), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
held AS (
  SELECT c.lang, c.phrase FROM counts c JOIN counts d
    ON d.lang = c.lang AND d.k > c.k AND d.f >= c.f AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')
  WHERE c.k > 1 GROUP BY ALL),
kept AS (SELECT c.* FROM counts c ANTI JOIN held h ON h.lang = c.lang AND h.phrase = c.phrase WHERE c.k > 1),
cuts AS (
  SELECT lang, phrase, f AS a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS first,
         array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS rest
  FROM kept, (SELECT unnest(range(1, 5)) AS cut) WHERE cut < k),
scored AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score, cut
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed WHERE rank <= 2000
"""
