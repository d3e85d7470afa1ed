"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A is a byte-level BPE vocabulary, B a piece vocabulary with byte fallback; both
read a text with one space before it.  Their token-byte incidence matrices are held
in compressed rows (``Csr``); the row-by-row (Gustavson) product A·Bᵀ has an entry
for each pair of tokens that share a byte: the overlap links.  Places where tokens
of both end cut the tokens into groups; the product of the group incidences
gives the links within a group, which ``Csr.products`` counts without making them.

Neither tokenizer joins anything across the place between a character that is not
white space and a following space or line end (``Aligner`` checks B's vocabulary for
that), so texts are cut there and a task aligns each distinct stretch once.

``align`` works in two steps: tasks read texts in blocks of bounded size and write,
for each text, its stretches and, for each block, how many of its texts hold each
pair of ids; the pairs are summed over all blocks, and each block is then scored with
the sums of the pairs that it has.  No table of all pairs is held anywhere.

Texts that are null, empty, or whose bytes one of the tokenizers changes have no
tokens: zeros and an empty string.  Repeated rows count as documents of their own,
null ids too.  Columns other than the two named ones are not looked at; an
empty table gives no rows.  A text of any length is whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A block ends after so many characters or distinct stretches.
BLOCK_CHARS, BLOCK_STRETCHES = 1 << 25, 200_000
#: Products of a Csr are made in steps of about so many entries.
STEP = 1 << 22
_STRETCH = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")


@dataclass
class Csr:
    """A sparse matrix in compressed rows: the columns of row i are ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @staticmethod
    def of_spans(ends: np.ndarray, width: int) -> Csr:
        """Row i has the columns from the end of row i - 1 to its own."""
        return Csr(np.concatenate([[0], ends]), np.arange(width), width)

    @staticmethod
    def of_places(columns: np.ndarray, width: int) -> Csr:
        """One entry a row."""
        return Csr(np.arange(len(columns) + 1), columns, width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transpose(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, self.rows()[order], len(self.starts) - 1)

    def products(self, other: Csr) -> np.ndarray:
        """How many entries of ``other`` each row meets: its entries in the product, if it meets no column twice."""
        n = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.columns])])
        return n[self.starts[1:]] - n[self.starts[:-1]]

    def multiply(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, columns, how often) of the product with ``other``, rows in order, some at a time.

        Row i is the sum of the rows of ``other`` that its columns name; equal columns are added up.
        """
        work = np.concatenate([[0], np.cumsum(self.products(other))])
        at = 0
        while at < len(self.starts) - 1:
            to = max(at + 1, int(np.searchsorted(work, work[at] + STEP, "right")) - 1)
            inner = self.columns[self.starts[at] : self.starts[to]]
            n = other.starts[inner + 1] - other.starts[inner]
            found = other.columns[np.repeat(other.starts[inner + 1] - np.cumsum(n), n) + np.arange(n.sum())]
            row = np.repeat(np.repeat(np.arange(at, to), np.diff(self.starts[at : to + 1])), n)
            key = row * other.width + found
            if len(key) and (np.diff(key) < 0).any():
                key.sort(kind="stable")
            first = np.flatnonzero(np.diff(key, prepend=-1))
            times = np.diff(np.append(first, len(key)))
            yield key[first] // other.width, key[first] % other.width, times
            at = to


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printing Latin-1 itself, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes of each id; loaded once a worker process."""

    def __init__(self, a: str = VOCABULARY_A, b: str = VOCABULARY_B):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True
        sign = _byte_of_sign()
        names = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = bytes(sign[c] for c in name) if all(c in sign for c in name) else name.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.space = self.b.piece_to_id("▁")
        # a piece with such a place inside could join what is cut there
        self.cut = not any(re.search(r"\S[ \n]", p.replace("▁", " ")) for i, p in enumerate(pieces) if not self.b.is_control(i))

    def stretches(self, text: str) -> list[str]:
        return _STRETCH.findall(" " + text) if self.cut else [" " + text]

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch(stretches, add_special_tokens=False)]
        # B puts a space before what it reads, unless that is nothing
        spaced = [s[0] == " " for s in stretches]
        b = self.b.encode([s[1:] if k else s for s, k in zip(stretches, spaced)], num_threads=1)
        return a, [[self.space] if s == " " else ids if k else ids[1:] for s, ids, k in zip(stretches, b, spaced)]


_LOADED: dict[tuple, Tokenizers] = {}


def tokenizers(a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> Tokenizers:
    return _LOADED.setdefault((a, b), _LOADED.get((a, b)) or Tokenizers(a, b))


def _starts(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])


@dataclass
class Aligned:
    """Alignment of a list of stretches; tokens, links and groups of all of them one after the other."""

    good: np.ndarray  # per stretch: both tokenizers keep its bytes
    a: np.ndarray  # ids
    b: np.ndarray
    a_starts: np.ndarray  # tokens, links, groups of stretch i: from starts[i] to starts[i + 1]
    b_starts: np.ndarray
    a_ends: np.ndarray  # last byte + 1 of each token, over all good stretches joined
    b_ends: np.ndarray
    group_ends: np.ndarray  # bytes at which tokens of both end
    group_starts: np.ndarray
    link_a: np.ndarray  # places in a and b of overlapping tokens
    link_b: np.ndarray
    link_starts: np.ndarray
    shared: np.ndarray  # per stretch: pairs of tokens of one group


def align_stretches(stretches: list[str], t: Tokenizers) -> Aligned:
    ids_a, ids_b = t.encode(stretches)
    raw = [s.encode("utf-8", "surrogatepass") for s in stretches]
    good = np.array(
        [b"".join(map(t.bytes_a.__getitem__, a)) == r == b"".join(map(t.bytes_b.__getitem__, b)) for a, b, r in zip(ids_a, ids_b, raw)], bool
    )
    for i in np.flatnonzero(~good):
        ids_a[i], ids_b[i], raw[i] = [], [], b""
    a_starts, b_starts = _starts([len(x) for x in ids_a]), _starts([len(x) for x in ids_b])
    a = np.fromiter((i for x in ids_a for i in x), np.int64, a_starts[-1])
    b = np.fromiter((i for x in ids_b for i in x), np.int64, b_starts[-1])
    a_ends = np.cumsum(np.array([len(t.bytes_a[i]) for i in a.tolist()], np.int64))
    b_ends = np.cumsum(np.array([len(t.bytes_b[i]) for i in b.tolist()], np.int64))
    stretch_ends, width = np.cumsum([len(r) for r in raw], dtype=np.int64), sum(map(len, raw))
    in_a = Csr.of_spans(a_ends, width)
    by_byte = Csr.of_spans(b_ends, width).transpose()
    parts = [(r, c) for r, c, _ in in_a.multiply(by_byte)]
    link_a = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in parts]])
    link_b = np.concatenate([np.zeros(0, np.int64), *[c for _, c in parts]])
    group_ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    in_group = Csr.of_places(np.searchsorted(group_ends, a_ends), len(group_ends))
    group_b = Csr.of_places(np.searchsorted(group_ends, b_ends), len(group_ends)).transpose()
    shared = np.concatenate([[0], np.cumsum(in_group.products(group_b))])
    return Aligned(
        good, a, b, a_starts, b_starts, a_ends, b_ends, group_ends, np.concatenate([[0], np.searchsorted(group_ends, stretch_ends, "right")]),
        link_a, link_b, np.searchsorted(link_a, a_starts), shared[a_starts[1:]] - shared[a_starts[:-1]],
    )


def shared_links(x: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``x.a`` and ``x.b`` of tokens of one group, some at a time."""
    in_group = Csr.of_places(np.searchsorted(x.group_ends, x.a_ends), len(x.group_ends))
    group_b = Csr.of_places(np.searchsorted(x.group_ends, x.b_ends), len(x.group_ends)).transpose()
    for rows, columns, _ in in_group.multiply(group_b):
        yield rows, columns


def group_texts(x: Aligned) -> list[str]:
    """The groups of each stretch, as ``a1,a2|b1;a3|b2``."""
    cut_a = np.concatenate([[0], np.searchsorted(x.a_ends, x.group_ends, "right")]).tolist()
    cut_b = np.concatenate([[0], np.searchsorted(x.b_ends, x.group_ends, "right")]).tolist()
    a, b = list(map(str, x.a.tolist())), list(map(str, x.b.tolist()))
    groups = [",".join(a[i:j]) + "|" + ",".join(b[k:m]) for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
    at = x.group_starts.tolist()
    return [";".join(groups[i:j]) for i, j in zip(at, at[1:])]


@dataclass
class Block:
    """What a task knows of the stretches of the texts it has read since the block began."""

    t: Tokenizers
    codes: dict[str, int] = field(default_factory=dict)
    pairs: dict[int, int] = field(default_factory=dict)  # id pair -> its number in the block
    texts: list[str] = field(default_factory=list)
    chars: int = 0

    def __post_init__(self):
        self.counts = np.zeros((0, 5), np.int64)  # a, b, groups, links, shared of each stretch
        self.good = np.zeros(0, bool)
        self.starts, self.places = np.zeros(1, np.int64), np.zeros(0, np.int32)  # pairs of each stretch
        self.held = np.zeros(0, np.int64)  # texts that hold each pair
        self.seen = np.zeros(0, np.int32)

    def _learn(self, stretches: list[str]) -> None:
        x = align_stretches(stretches, self.t)
        key = (x.a[x.link_a] << 32) | x.b[x.link_b]
        places = [self.pairs.setdefault(k, len(self.pairs)) for k in key.tolist()]
        self.places = np.concatenate([self.places, np.array(places, np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + x.link_starts[1:]])
        self.counts = np.concatenate([self.counts, np.column_stack([np.diff(s) for s in (x.a_starts, x.b_starts, x.group_starts, x.link_starts)] + [x.shared])])
        self.good = np.concatenate([self.good, x.good])
        self.texts += group_texts(x)
        more = len(self.pairs) - len(self.held)
        self.held, self.seen = np.append(self.held, np.zeros(more, np.int64)), np.append(self.seen, np.zeros(more, np.int32))

    def read(self, texts: list[str | None]) -> list[tuple[list[int], np.ndarray, np.ndarray, str]]:
        """Per text: the five counts, its distinct stretches, how often each, and the digest of its groups."""
        before, codes = len(self.codes), self.codes
        docs = [[codes.setdefault(s, len(codes)) for s in self.t.stretches(x)] if x else [] for x in texts]
        self.chars += sum(len(x or "") for x in texts)
        if len(codes) > before:
            self._learn(list(codes)[before:])
        out = []
        for d in docs:
            part, n = np.unique(np.array(d, np.int64), return_counts=True)
            if not len(d) or not self.good[part].all():
                out.append(([0] * 5, np.zeros(0, np.int64), np.zeros(0, np.int64), ""))
                continue
            size = self.starts[part + 1] - self.starts[part]
            total = int(size.sum())
            p = self.places[np.repeat(self.starts[part + 1] - np.cumsum(size), size) + np.arange(total)]
            order = np.arange(total, dtype=np.int32)
            self.seen[p] = order
            self.held[p[self.seen[p] == order]] += 1
            groups = ";".join(map(self.texts.__getitem__, d))
            out.append(((n @ self.counts[part]).tolist(), part, n, hashlib.sha256(groups.encode()).hexdigest()))
        return out

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.codes) >= BLOCK_STRETCHES


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")


def _read_blocks(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Rows of three kinds, by block: texts (0), id pairs (1), and the pairs of the block's stretches (2)."""
    longs = [T.StructField(c, T.LongType()) for c in _COUNTS]
    schema = T.StructType(
        [T.StructField("kind", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("doc_id", docs.schema[doc_id].dataType), *longs]
        + [T.StructField("groups_sha256", T.StringType()), T.StructField("x", T.BinaryType()), T.StructField("y", T.BinaryType())]
        + [T.StructField(c, T.IntegerType()) for c in ("place", "a", "b")]
        + [T.StructField("held", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, t = to_arrow_schema(schema), tokenizers()
        number, block = TaskContext.get().partitionId() << 32, Block(t)

        def rows(n: int, kind: int, **cells) -> pa.RecordBatch:
            every = {"kind": pa.array(np.full(n, kind, np.int32)), "block": pa.array(np.full(n, number, np.int64)), **cells}
            return pa.RecordBatch.from_arrays([every[f.name].cast(f.type) if f.name in every else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def ended() -> Iterator[pa.RecordBatch]:
            key = np.fromiter(block.pairs, np.int64, len(block.pairs))
            for i in range(0, len(key), 1 << 16):
                k = key[i : i + (1 << 16)]
                cells = {"place": np.arange(i, i + len(k), dtype=np.int32), "a": (k >> 32).astype(np.int32), "b": (k & 0xFFFFFFFF).astype(np.int32), "held": block.held[i : i + len(k)]}
                yield rows(len(k), 1, **{c: pa.array(v) for c, v in cells.items()})
            yield rows(1, 2, x=pa.array([block.starts.astype("<i8").tobytes()], pa.binary()), y=pa.array([block.places.astype("<i4").tobytes()], pa.binary()))

        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < BLOCK_CHARS // 8):
                    size += len(texts[end] or "")
                    end += 1
                found = block.read(texts[at:end])
                yield rows(
                    end - at, 0, doc_id=batch.column(0).slice(at, end - at), **{c: pa.array([r[0][i] for r in found], pa.int64()) for i, c in enumerate(_COUNTS)},
                    groups_sha256=pa.array([r[3] for r in found], pa.string()),
                    x=pa.array([r[1].astype("<i4").tobytes() for r in found], pa.binary()), y=pa.array([r[2].astype("<i4").tobytes() for r in found], pa.binary()),
                )
                at = end
                if block.full():
                    yield from ended()
                    number, block = number + 1, Block(t)
        if block.chars or block.codes:
            yield from ended()

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold the pair, and whether no pair of its A id is held by more."""
    n = blocks.where("kind = 1").groupBy("a", "b").agg(F.sum("held").alias("n"))
    # an A id has as many partners as B has ids, at most
    return n.withColumn("best", (F.col("n") == F.max("n").over(Window.partitionBy("a"))).cast("int"))


def align(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and n_shared of every row."""
    blocks = stored(_read_blocks(docs, text, doc_id), "token-blocks")
    pairs = blocks.where("kind = 1").select("block", "place", "a", "b").join(pair_counts(blocks), ["a", "b"]).select(F.col("block").alias("of_block"), "place", "n", "best")
    texts = blocks.where("kind <> 1").select("kind", "block", "doc_id", *_COUNTS, "groups_sha256", "x", "y")
    out = T.StructType(
        [texts.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]]
        + [T.StructField("groups_sha256", T.StringType()), T.StructField("n_shared", T.LongType())]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, spread = left.filter(pc.equal(left["kind"], 0)), left.filter(pc.equal(left["kind"], 2))
        n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right["place"].to_numpy()
        n[place], best[place] = right["n"].to_numpy(), right["best"].to_numpy()
        starts, places = np.zeros(1, np.int64), np.zeros(0, np.int32)
        if spread.num_rows:
            starts, places = np.frombuffer(spread["x"][0].as_py(), "<i8"), np.frombuffer(spread["y"][0].as_py(), "<i4")
        sums = [np.concatenate([[0], np.cumsum(v[places])]) for v in (best, n)]
        of = [s[starts[1:]] - s[starts[:-1]] for s in sums]  # of each stretch
        totals: list[list[int]] = [[], []]
        for x, y in zip(left["x"].to_pylist(), left["y"].to_pylist()):
            part, times = np.frombuffer(x, "<i4"), np.frombuffer(y, "<i4").astype(np.int64)
            for k in (0, 1):
                totals[k].append(int(of[k][part] @ times))
        cells = {"n_best": pa.array(totals[0], pa.int64()), "count_sum": pa.array(totals[1], pa.int64())}
        return pa.table([cells[c] if c in cells else left[c] for c in out.names], names=out.names)

    return texts.groupBy("block").cogroup(pairs.groupBy("of_block")).applyInArrow(run, out)


def alignments(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The alignment itself: ids, byte ends, groups and overlap links (places of tokens, from 0) of every row."""
    schema = T.StructType(
        [docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema["doc_id"]]
        + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("a_ids", "b_ids", "a_ends", "b_ends", "group_ends", "link_a", "link_b")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers()
        for batch in batches:
            for i, x in enumerate(batch.column(1).to_pylist()):
                found = align_stretches(t.stretches(x), t) if x else None
                cells = [found.a, found.b, found.a_ends, found.b_ends, found.group_ends, found.link_a, found.link_b] if found and found.good.all() else [np.zeros(0, np.int64)] * 7
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *[pa.array([c], pa.list_(pa.int64())) for c in cells]], names=schema.names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`")).mapInArrow(run, schema)


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and n_shared)."""
    return align(table(spark, sf_dir, "documents"))
