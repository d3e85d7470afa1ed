"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text; ``RULES`` names
measures and their bounds and becomes one boolean expression.  No Python runs on
the executors, and no row leaves its task.

The bound on stop words counts for texts of a language with a list: not where a
column ``lang`` names another language, nor where one letter in a hundred or more
is outside the alphabets of the listed ones.  Without a name (null, empty, ``und``
or no such column) the letters alone decide.

Null and empty texts have no words, so they fail the base rule; an empty table
gives no rows.  A text of any length is measured whole, as one row of its task.
Repeated rows are judged each for itself; columns but text and ``lang`` are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

# White space that ends a word, counted symbols, marks that open a list line.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
BULLETS = ["-", "•", "‣", "▪", "●"]

# Frequent function words, by language.
STOP_WORDS = {
    "en": "the of and to in a is that for it was on with as by this be are from at or an not they which you his her has had but",
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an aus er hat dass sie nach bei",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me",
}

# Names that the languages of STOP_WORDS and no language have in a column ``lang``, before any region.
LISTED = [*STOP_WORDS, "eng", "deu", "ger", "fra", "fre", "spa"]
UNNAMED = ["", "und"]
# The listed languages' letters besides A to Z, and the share of other letters that shows another language.
LETTERS = "ÄÖÜẞÀÂÆÇÉÈÊËÎÏÔŒÙÛŸÑÁÍÓÚäöüßàâæçéèêëîïôœùûÿñáíóúªº"
FOREIGN_PERCENT = 1

#: Words in a window whose repetition counts.
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

#: measure, least, most; a text is kept if every measure lies within its bounds.
RULES: list[tuple[str, float | None, float | None]] = [
    ("mean_word_chars", 2.5, 12.0),
    ("symbols_per_word", None, 0.1),
    ("stop_words_per_word", 0.02, None),
    ("duplicate_line_share", None, 0.5),
    ("bullet_line_share", None, 0.9),
    ("ellipsis_line_share", None, 0.3),
]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words: Column, window: int) -> Column:
    """Words lying in a window of ``window`` words that the text has twice or more."""

    def count(keys: Column) -> Column:
        placed = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def same(s, x, j):  # is the neighbour j the same window?
            return F.coalesce(F.get(s, j)["k"] == x["k"], F.lit(False))

        def twice(s):
            kept = F.filter(s, lambda x, j: same(s, x, j - 1) | same(s, x, j + 1))
            return F.array_sort(F.transform(kept, lambda x: x["i"]))

        def covered(p):
            reach = F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window))))
            return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

        found = let(let(placed, twice), covered)
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(found)

    def keys(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (window - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(window))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(let(hashes, keys), count)).cast("long")


def measures(text: Column, stop_words: list[str] | None = None, window: int = WINDOW) -> Column:
    """Struct of counts of one text."""
    stop = stop_words or sorted({w for ws in STOP_WORDS.values() for w in ws.split()})

    def of(t, words, lines):
        long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
        return F.struct(
            long(F.size(words)).alias("n_words"),
            long(F.length(_without(t, SPACES))).alias("word_chars"),
            long(F.length(t) - F.length(_without(t, SYMBOLS))).alias("n_symbols"),
            long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            _repeat_words(words, window).alias("n_repeat_words"),
            long(F.size(F.filter(words, lambda w: F.lower(w).isin(stop)))).alias("n_stop_words"),
            long(F.size(lines)).alias("n_lines"),
            long(F.size(F.filter(lines, lambda x: F.substring(F.ltrim(x), 1, 1).isin(BULLETS)))).alias("n_bullet_lines"),
            long(
                F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
            ).alias("n_ellipsis_lines"),
        )

    def parts(t):
        words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: _without(x, SPACES) != "")
        return let(words, lambda w: let(lines, lambda x: of(t, w, x)))

    return let(F.coalesce(text, F.lit("")), parts)


def listed(text: Column, lang: Column) -> Column:
    """Whether the stop-word lists are for this text, by its language's name and its letters."""
    name = F.lower(F.regexp_extract(F.coalesce(lang, F.lit("")), r"^\s*([^-_\s]*)", 1))
    count = lambda others: F.length(F.regexp_replace(text, rf"[\P{{L}}{others}]+", ""))
    return name.isin(LISTED + UNNAMED) & ((100 * count("A-Za-z" + LETTERS) < FOREIGN_PERCENT * count("")) | (count("") == 0))


def verdict(m: Column, rules=None, is_listed: Column | None = None) -> tuple[Column, Column]:
    """(base_failed, kept) from the struct of counts; ``is_listed`` false frees from the bound on stop words."""
    n = m["n_words"]
    base_failed = (n < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    share = lambda c, of: m[c] / F.greatest(m[of], F.lit(1))
    known = {
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "stop_words_per_word": share("n_stop_words", "n_words"),
        "duplicate_line_share": share("n_dup_lines", "n_lines"),
        "bullet_line_share": share("n_bullet_lines", "n_lines"),
        "ellipsis_line_share": share("n_ellipsis_lines", "n_lines"),
    }
    kept = ~base_failed
    for name, least, most in RULES if rules is None else rules:
        if name == "stop_words_per_word" and is_listed is not None:
            kept = kept & ((known[name] >= least) | ~is_listed)
            continue
        kept = kept & (known[name] >= least) if least is not None else kept
        kept = kept & (known[name] <= most) if most is not None else kept
    return base_failed, kept


def _listed_in(docs: DataFrame, text: str, lang: str) -> Column:
    name = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    return listed(F.coalesce(F.col(text), F.lit("")), name)


def keep(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text passes every rule; columns as they are."""
    return docs.where(let(measures(F.col(text)), lambda m: verdict(m, is_listed=_listed_in(docs, text, lang))[1]))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every document."""
    docs = table(spark, sf_dir, "documents")

    def judged(m):
        base_failed, kept = verdict(m, is_listed=_listed_in(docs, "text", "lang"))
        return F.struct(m.alias("m"), base_failed.alias("base_failed"), kept.alias("kept"))

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = docs.select("doc_id", let(measures(F.col("text")), judged).alias("r"))
    return found.select("doc_id", *[f"r.m.{c}" for c in counts], "r.base_failed", "r.kept")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         lower(regexp_extract(coalesce(lang, ''), '^[\x20\x09-\x0D]*([^-_\x20\x09-\x0D]*)', 1)) AS name,
         length(regexp_replace(coalesce(text, ''), '\P{L}+', '', 'g')) AS letters,
         length(regexp_replace(coalesce(text, ''), '[\P{L}A-Za-z__LETTERS__]+', '', 'g')) AS others,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), x AS (
  SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM x) WHERE c > 1
), g AS (
  SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS c FROM r
), p AS (SELECT doc_id, sum(c) AS c FROM g GROUP BY doc_id), m AS (
  SELECT d.doc_id, name IN __NAMES__ AND (letters = 0 OR 100 * others < __PERCENT__ * letters) AS listed,
         CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(p.c, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
         len(list_filter(w, lambda y: list_contains(__STOP__, lower(y)))) AS n_stop,
         len(list_filter(l, lambda y: regexp_matches(y, '^ *[-\x{2022}\x{2023}\x{25aa}\x{25cf}]'))) AS n_bullet,
         len(list_filter(l, lambda y: regexp_matches(y, '(\.\.\.|\x{2026}) *$'))) AS n_ellipsis
  FROM d LEFT JOIN p ON p.doc_id = d.doc_id
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         greatest(n_words, 1) AS nw, greatest(n_lines, 1) AS nl FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / nw BETWEEN 2.5 AND 12.0 AND n_symbols / nw <= 0.1 AND (NOT listed OR n_stop / nw >= 0.02)
       AND n_dup_lines / nl <= 0.5 AND n_bullet / nl <= 0.9 AND n_ellipsis / nl <= 0.3 AS kept
FROM b
"""
for _mark, _value in {
    "__STOP__": "[" + ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws.split()})) + "]",
    "__NAMES__": "(" + ", ".join(f"'{n}'" for n in LISTED + UNNAMED) + ")",
    "__LETTERS__": LETTERS,
    "__PERCENT__": str(FOREIGN_PERCENT),
}.items():
    ORACLE = ORACLE.replace(_mark, _value)
