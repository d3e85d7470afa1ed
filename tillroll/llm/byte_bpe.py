"""Byte-level BPE: ranked merges folded by Spark's higher-order functions.

``encode`` splits a text with the vocabulary's pattern and turns every distinct
piece into ids by a fold: an ``aggregate`` that holds the piece as a string with a
character for each id, from those of its single bytes on, and for the merge rank
of each neighbouring pair, and joins the best-ranked, leftmost pair until no pair
has a rank.  Ranks sit in the plan as literal maps, of byte strings and of pairs of
ids, split into buckets so that a lookup reads one short map.

The commonest pieces of the corpus (``head`` of them, a fixed bound) are folded,
their bytes made and decoded, once and become a second literal; a piece outside
the head is folded once for each document that has it.  The head only saves work: ids never depend on it.
``decode`` puts the byte strings of the ids together again.

Null text counts as empty (no ids, empty bytes).  Repeated rows give repeated
results; columns other than the two named ones are not looked at.  A piece of
any length is whole; long ones (over ``LONG_PIECE`` bytes) are held as byte
strings and join all occurrences of the best pair in one step where that is the
same as one at a time.
"""

from __future__ import annotations

import base64

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: No pair to join; above every rank.
NONE = 2**31 - 1
LONG_PIECE = 512
#: Characters of a fold's state: ranks from ``FIRST_RANK`` on, above them ``NO_RANK``, above it the ids.
FIRST_RANK, FIRST_ID = 0x10000, 0x80000
NO_RANK, EDGE = chr(FIRST_ID - 1), chr(0x10FFFF)
LATIN = "".join(map(chr, range(256)))
MOST_RANKS = FIRST_ID - FIRST_RANK - 1
#: Pieces encoded ahead (some 130 bytes each in every task's plan), and the share of documents (one in so many) that picks them.
HEAD = 800_000
HEAD_ONE_IN = 2
BUCKETS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _bucket(key: Column, n: int = BUCKETS) -> Column:
    return F.pmod(F.hash(key), F.lit(n))


def _one_row(spark: SparkSession, value, schema: str) -> DataFrame:
    return spark.createDataFrame([(value,)], schema)


class Vocabulary:
    """Ranks and byte strings of the ids, each held as one value of a plan.

    They enter a plan as scalar subqueries, which Spark evaluates once and ships
    with the tasks as it does a literal, without printing 50,000 entries in every
    plan.  Spark takes no subquery inside a lambda, so ``project`` puts each
    beside the rows as a column that one expression of the next projection reads
    once; the two projections become one, and no row ever holds the value.
    Size: the vocabulary's, whatever the corpus.
    """

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        whole = pa.table({"k": pa.array(ranks.keys(), pa.binary()), "v": pa.array(ranks.values(), pa.int32())})
        size = max(ranks.values(), default=-1) + 1
        if size > MOST_RANKS:
            raise ValueError(f"{size} ranks: a fold's state has characters for {MOST_RANKS}")
        ids = {bytes([b]): size + b for b in range(256)} | ranks  # a byte without a rank takes part, as no id
        sign = {k: chr(FIRST_ID + v) for k, v in ids.items()}
        halves = {}
        for k, v in ranks.items():
            for i in range(1, len(k)):
                if k[:i] in sign and k[i:] in sign:
                    halves[sign[k[:i]] + sign[k[i:]]] = chr(FIRST_RANK + v)
        pairs = pa.table({"k": list(halves), "v": list(halves.values())}, schema=pa.schema({"k": pa.string(), "v": pa.string()}))
        signs = [chr(FIRST_ID + i) for i in range(size)]
        self.ranks = (
            _in_buckets(spark.createDataFrame(whole), "k", "v")
            .select(F.col("m").alias("whole"))
            .crossJoin(_in_buckets(spark.createDataFrame(pairs), "k", "v").select(F.col("m").alias("pairs")))
            .crossJoin(spark.createDataFrame([("".join(sign[bytes([b])] for b in range(256)), signs)], "bytes string, ids array<string>"))
            .select(F.struct("whole", "pairs", "bytes", "ids").alias("ranks"))
        )
        pieces = [""] * size
        for k, v in ranks.items():
            pieces[v] = k.hex()
        self.pieces = _one_row(spark, pieces, "p array<string>")
        self.little = _one_row(spark, [i.to_bytes(4, "little").hex() for i in range(len(pieces))], "p array<string>")



def project(df: DataFrame, into: str, body, **values: DataFrame) -> DataFrame:
    """``df`` and a column ``into``: ``body``, given the one value of each frame by name."""
    wide = df.select("*", *[v.scalar().alias(f"__{k}__") for k, v in values.items()])

    def bound(left, given):
        if not left:
            return body(**given)
        return let(F.col(f"__{left[0]}__"), lambda v: bound(left[1:], {**given, left[0]: v}))

    return wide.select(*[F.col(f"`{c}`") for c in df.columns], bound(list(values), {}).alias(into))


def joined_bytes(cells: Column, ids: Column) -> Column:
    """The byte strings (hexadecimal in ``cells``) of an array of ids, put together."""
    return F.unhex(F.array_join(F.transform(ids, lambda i: cells[i]), ""))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "bytes") -> DataFrame:
    """``df`` with the bytes that each array of ids stands for."""
    return project(df, into, lambda pieces: joined_bytes(pieces, F.coalesce(F.col(ids), F.array())), pieces=vocabulary.pieces)


class Merges:
    """The fold of ranked merges, over the rank maps of a vocabulary."""

    def __init__(self, ranks: Column):
        self._map, self._pairs, self._bytes, self._ids = ranks["whole"], ranks["pairs"], ranks["bytes"], ranks["ids"]

    def rank(self, piece: Column) -> Column:
        """Rank of a byte string, ``NONE`` if it has none."""
        return F.coalesce(F.try_element_at(self._map[_bucket(piece)], piece), F.lit(NONE))

    def _pair_cell(self, pair: Column) -> Column:
        """The rank of what two ids stand for and the id it becomes; ``NO_RANK`` if it has none."""
        return F.coalesce(F.try_element_at(self._pairs[_bucket(pair)], pair), F.lit(NO_RANK))

    def _join_first(self, line: Column) -> Column:
        """Join the first pair of the best rank, if there is one.  Only the two pairs beside it get new ranks."""

        def join(rank, at):  # at: place of that rank in the line
            def put(new):
                left = self._pair_cell(F.concat(F.substring(line, at - 3, F.lit(1)), new))
                right = self._pair_cell(F.concat(new, F.substring(line, at + 3, F.lit(1))))
                return F.overlay(line, F.concat(left, new, right), at - 2, F.lit(5))

            return let(self._ids[F.ascii(rank) - FIRST_RANK], put)

        def found(rank):
            return F.when(rank < NO_RANK, let(F.instr(line, rank), lambda at: join(rank, at))).otherwise(line)

        return let(F.array_min(F.split(line, "")), found)

    def _fold_line(self, piece: Column) -> Column:
        """Ids of one piece by as many steps as it may have joins.

        The state is a string: a character for each id and between two ids one for
        the rank of the pair, all ranks below all ids; ``EDGE`` pairs with nothing.
        Arrays of ids and ranks took somewhat longer (README).
        """
        letters = F.decode(piece, "ISO-8859-1")  # a character for each byte
        ids = F.call_function("translate", letters, F.lit(LATIN), self._bytes)

        def start(ids):
            cells = F.transform(
                F.sequence(F.lit(1), F.octet_length(piece)),
                lambda i: F.concat(F.substring(ids, i, F.lit(1)), self._pair_cell(F.substring(ids, i, F.lit(2)))),
            )
            return F.concat(F.lit(EDGE + NO_RANK), F.array_join(cells, ""), F.lit(EDGE))

        def end(line):
            cells = F.split(F.substring(line, F.lit(3), F.char_length(line) - 3), "")
            codes = F.transform(F.filter(cells, lambda c: c > NO_RANK), lambda c: F.ascii(c) - FIRST_ID)
            return F.transform(codes, lambda c: F.when(c < F.size(self._ids), c).otherwise(F.lit(NONE)))

        return F.aggregate(F.sequence(F.lit(2), F.octet_length(piece)), let(ids, start), lambda s, _: self._join_first(s), end)

    def _pair_ranks(self, parts: Column) -> Column:
        return F.transform(
            F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p, i: self.rank(F.concat(p, parts[i + 1]))
        )

    @staticmethod
    def _state(parts: Column, ranks: Column, at: Column) -> Column:
        """``at``: 1-based place of the pair to join next, 0 if it is to be looked up."""
        return F.struct(parts.alias("parts"), ranks.alias("ranks"), at.cast("int").alias("at"))

    def _find(self, s: Column) -> Column:
        best = F.array_min(s["ranks"])
        return self._state(s["parts"], s["ranks"], F.when(best < NONE, F.array_position(s["ranks"], best)).otherwise(F.lit(0)))

    def _join(self, s: Column) -> Column:
        """Join the pair at ``at``; only the two pairs beside it get new ranks."""
        parts, ranks, at = s["parts"], s["ranks"], s["at"]
        new, none = F.concat(parts[at - 1], parts[at]), F.array().cast("array<int>")
        left = F.when(at > 1, F.array(self.rank(F.concat(parts[at - 2], new)))).otherwise(none)
        right = F.when(at < F.size(ranks), F.array(self.rank(F.concat(new, parts[at + 1])))).otherwise(none)
        return self._state(
            F.concat(F.slice(parts, F.lit(1), at - 1), F.array(new), F.slice(parts, at + 2, F.size(parts))),
            F.concat(F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right, F.slice(ranks, at + 2, F.size(ranks))),
            F.lit(0),
        )

    def _join_all(self, s: Column) -> Column:
        """Join every pair of the best rank, left to right, unless a join makes a better pair: then only the first."""
        parts, ranks = s["parts"], s["ranks"]
        best = ranks[s["at"] - 1]
        none = F.array().cast("array<int>")

        def pick(found: Column) -> Column:  # of touching pairs every second
            start = F.struct(none.alias("at"), F.lit(-2).alias("last"))
            return F.aggregate(
                found,
                start,
                lambda a, i: F.when(i - a["last"] < 2, a).otherwise(F.struct(F.concat(a["at"], F.array(i)).alias("at"), i.alias("last"))),
                lambda a: a["at"],
            )

        def build(at):
            def beside(i):  # ranks that stand beside the join at i while it happens
                new = F.concat(parts[i], parts[i + 1])
                one, two = parts[F.greatest(i - 1, F.lit(0))], parts[F.greatest(i - 2, F.lit(0))]
                return F.least(
                    F.when(i + 2 < F.size(parts), self.rank(F.concat(new, F.get(parts, i + 2)))).otherwise(F.lit(NONE)),
                    F.when(i > 0, self.rank(F.concat(one, new))).otherwise(F.lit(NONE)),
                    F.when(i > 1, self.rank(F.concat(two, one, new))).otherwise(F.lit(NONE)),
                )

            bounds = F.concat(F.array(F.lit(-2)), at, F.array(F.size(parts)))
            spread = F.flatten(
                F.transform(
                    F.slice(bounds, F.lit(2), F.size(bounds)),
                    lambda i, k: F.concat(
                        F.slice(parts, bounds[k] + 3, i - bounds[k] - 2),
                        F.when(i < F.size(parts), F.array(F.concat(F.get(parts, i), F.get(parts, i + 1)))).otherwise(
                            F.array().cast("array<binary>")
                        ),
                    ),
                )
            )
            return F.when(F.exists(at, lambda i: beside(i) < best), self._join(s)).otherwise(
                let(spread, lambda p: self._state(p, self._pair_ranks(p), F.lit(0)))
            )

        found = F.filter(F.transform(ranks, lambda r, i: F.when(r == best, i)), lambda i: i.isNotNull())
        return let(let(found, pick), build)

    def fold(self, piece: Column) -> Column:
        """Ids of one piece (bytes): ranked merges from single bytes on; a long one takes a step to find each and a step to make it."""
        start = F.transform(F.sequence(F.lit(1), F.octet_length(piece)), lambda i: F.substring(piece, i, F.lit(1)))
        long = F.aggregate(
            F.sequence(F.lit(2), 2 * F.octet_length(piece) - 1),
            let(start, lambda p: self._state(p, self._pair_ranks(p), F.lit(0))),
            lambda s, _: F.when(s["at"] > 0, self._join_all(s)).otherwise(self._find(s)),
            lambda s: F.transform(s["parts"], self.rank),
        )

        def ids(whole):
            found = F.when(whole != NONE, F.array(whole))
            return found.when(F.octet_length(piece) <= LONG_PIECE, self._fold_line(piece)).otherwise(long)

        return let(self.rank(piece), ids)


def split_text(text: Column, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The pattern's matches; (?U) gives \\s its Unicode meaning."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def common_pieces(docs: DataFrame, text: str, head: int, one_in: int) -> DataFrame:
    """(w): the pieces that most documents of a fixed share have, ``head`` at most."""
    words = F.array_distinct(split_text(F.col(text)))
    return (
        docs.where(F.pmod(F.xxhash64(F.col(text)), F.lit(one_in)) == 0)
        .select(F.explode(words).alias("w"))
        .where((F.octet_length("w") > 1) & (F.octet_length("w") <= 64))
        .groupBy("w")
        .count()
        .where("count > 1")
        .orderBy(F.desc("count"), "w")
        .limit(head)
        .select("w")
    )


def _in_buckets(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """One row: an array over the buckets of maps from ``key`` to ``value``."""
    kind = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}
    none = F.map_from_arrays(F.array().cast(f"array<{kind[key]}>"), F.array().cast(f"array<{kind[value]}>"))
    cells = pairs.groupBy(_bucket(F.col(key)).alias("b")).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))
    every = pairs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(cells, "b", "left")
    placed = F.collect_list(F.struct("b", F.coalesce("m", none).alias("m")))
    return every.agg(F.transform(F.array_sort(placed, lambda x, y: x["b"] - y["b"]), lambda x: x["m"]).alias("m"))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    into: str = "ids",
    pattern: str = public_tokenizers.PATTERN,
    head: int = HEAD,
    one_in: int = HEAD_ONE_IN,
    each=None,
    digest=F.flatten,
    **values: DataFrame,
) -> DataFrame:
    """``docs`` with the array of ids of each text in a column ``into``.

    ``each`` (given a piece's ids and the one value of each frame in ``values``) makes
    something else of them, once for a piece of the head; ``digest`` makes a row's
    value of the array of what its pieces have, in order.
    """

    def cell(piece, ranks, **rest):
        ids = Merges(ranks).fold(piece.cast("binary"))
        return let(ids, lambda i: each(i, **rest)) if each else ids

    values = {"ranks": vocabulary.ranks, **values}
    ahead = common_pieces(docs, text, head, one_in).repartition(16, "w")
    known = _in_buckets(project(ahead, "v", lambda **given: cell(F.col("w"), **given), **values), "w", "v")

    def of_words(words, done, given):
        def of_found(found):
            rare = F.array_distinct(F.filter(words, lambda w, i: found[i].isNull()))
            own = let(rare, lambda r: F.map_from_arrays(r, F.transform(r, lambda w: cell(w, **given))))
            return let(own, lambda m: digest(F.transform(found, lambda f, i: F.coalesce(f, m[words[i]]))))

        return let(F.transform(words, lambda w: F.try_element_at(done[_bucket(w)], w)), of_found)

    def body(done, **given):  # a lambda's result is copied: arrays as long as the text stay inside
        return let(split_text(F.col(text), pattern), lambda words: of_words(words, done, given))

    return project(docs, into, body, done=known, **values)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    vocabulary = Vocabulary(spark, read_ranks(public_tokenizers.path(VOCABULARY)))

    def each(ids, little, pieces):  # bytes, held as strings for the sake of array_join
        return F.struct(joined_bytes(little, ids).cast("string").alias("little"), joined_bytes(pieces, ids).cast("string").alias("decoded"))

    def digest(found):
        decoded = F.array_join(found["decoded"], "").cast("binary")

        def of_row(little):
            return F.struct(
                (F.octet_length(little) / 4).cast("long").alias("n_tokens"),
                F.sha2(little, 256).alias("ids_sha256"),
                F.sha2(decoded, 256).alias("decoded_sha256"),
            )

        return let(F.array_join(found["little"], "").cast("binary"), of_row)

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = encode(docs, vocabulary, into="r", each=each, digest=digest, little=vocabulary.little, pieces=vocabulary.pieces)
    return found.select("doc_id", "r.n_tokens", "r.ids_sha256", "r.decoded_sha256")
