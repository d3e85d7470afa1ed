"""Best-fit packing improved by swaps between underfull bins.

``tokenise`` cuts each text's ids into pieces of at most ``size``; ``pack`` puts
pieces into bins.  Full pieces are bins by themselves.  The others are dealt
evenly to groups (by a hash of the piece and its row, so no key gathers) and each group is
packed in a task: best-fit decreasing first, then local search.  The search
takes the emptiest bin and moves its pieces, or exchanges one of them for a
smaller one, or two of them for one, with whichever of all other underfull bins
raises the sum of squared fills most; a bin that runs empty is closed.  A group's
search ends at its volume bound, when no step raises the sum, or after ``PATIENCE``
steps that closed no bin.

The number of groups follows the number of pieces, so a task's work is bounded;
a group's waste is below one bin beside what its lengths force.  Null text
counts as empty: an end id alone.  Repeated rows are packed each for itself;
other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import read_ranks
from .common import stored, table

VOCABULARY = "byte_bpe_50k.json"
SIZE, END = 1024, 2
#: Pieces that a task packs, on average, and steps of its search without a closed bin.
GROUP, PATIENCE = 20_000, 2_000


@lru_cache(maxsize=2)
def encoder(ranks: str = "byte_bpe_50k.tiktoken") -> tiktoken.Encoding:
    """The same vocabulary as ranks, without its marker: what token files are written with."""
    found = read_ranks(public_tokenizers.path(ranks))
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str = VOCABULARY):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


class Encoder:
    """Ids of whole texts as the json gives them.

    A text that holds the vocabulary's marker (``<|endoftext|>``, an id of its own) is
    read by ``tokenizers`` from the json; any other by the faster library from the same
    vocabulary as ranks, which gives the same ids (tested with every code point).
    """

    def __init__(self):
        self.tokenizer, self.fast = tokenizer(), encoder()
        self.markers = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __call__(self, text: str | None) -> np.ndarray:
        if text and any(m in text for m in self.markers):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text or "")


def tokenise(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; only the first piece of a cut text may be shorter."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, t in enumerate(b.column(1)):
                ids = np.append(encode(t.as_py()), np.uint32(end)).astype("<u4", copy=False)
                cuts = [0, *range(len(ids) % size or min(size, len(ids)), len(ids) + 1, size)]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(z - a)
                    crc.append(zlib.crc32(ids[a:z].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                names=schema.names,
            )

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


class Bins:
    """Bins of one group, by fill, and the search over them."""

    def __init__(self, lengths: list[int], size: int):
        self.size, self.lengths = size, np.asarray(lengths, np.int64)
        self.members: list[list[int]] = []
        self.fill = np.zeros(len(lengths), np.int64)  # a place for each bin there could be
        self.bin_of = np.zeros(len(lengths), np.int64)
        order: list[tuple[int, int]] = []  # (fill, bin) of underfull bins, ascending
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            # best fit: the fullest bin that still takes the piece
            at = bisect.bisect_right(order, (size - lengths[i], len(self.members)))
            if at:
                _, b = order.pop(at - 1)
            else:
                b = len(self.members)
                self.members.append([])
            self._put(i, b)
            if self.fill[b] < size:
                bisect.insort(order, (int(self.fill[b]), b))

    def _put(self, i: int, b: int) -> None:
        self.members[b].append(i)
        self.bin_of[i] = b
        self.fill[b] += self.lengths[i]

    def _take(self, i: int, b: int) -> None:
        self.members[b].remove(i)
        self.fill[b] -= self.lengths[i]

    def _offers(self, b: int) -> dict[int, tuple[int, ...]]:
        """What ``b`` can give, one piece or two, by length.

        Two pieces of a length stand for all of it, so a bin of any number of pieces has
        at most some ninety to pair.
        """
        same: dict[int, list[int]] = {}
        for i in self.members[b]:
            same.setdefault(int(self.lengths[i]), []).append(i)
        found = {length: (ids[0],) for length, ids in same.items()}
        for (x, i), (y, j) in combinations([(length, i) for length, ids in same.items() for i in ids[:2]], 2):
            found.setdefault(x + y, (i, j))
        return found

    def _improve(self, b: int) -> bool:
        """The move or exchange between ``b`` and a bin at least as full that raises the squared fills most.

        ``b`` gives one or two pieces and gets nothing, or one smaller piece, back.  Every
        underfull bin and every piece in one is looked at.
        """
        mine = int(self.fill[b])
        fill = self.fill[self.bin_of]
        near = np.flatnonzero((fill < self.size) & (fill >= mine) & (self.bin_of != b))
        if not len(near):
            return False
        # what comes back: a piece of those bins, or nothing (length 0)
        bins, first = np.unique(self.bin_of[near], return_index=True)
        back = np.concatenate([self.lengths[near], np.zeros(len(bins), np.int64)])
        full = np.concatenate([fill[near], fill[near[first]]])
        offers = self._offers(b)
        best, choice = 0, None
        for length, give in offers.items():
            gain = length - back
            better = np.where((gain > 0) & (gain <= self.size - full), gain * (full - mine + gain), 0)
            at = int(better.argmax())
            if better[at] > best:
                best, choice = int(better[at]), (give, at)
        if choice is None:
            return False
        give, at = choice
        other = int(self.bin_of[near[at]]) if at < len(near) else int(bins[at - len(near)])
        if at < len(near):
            self._take(int(near[at]), other)
        for i in give:
            self._take(i, b)
            self._put(i, other)
        if at < len(near):
            self._put(int(near[at]), b)
        return True

    def search(self, patience: int = PATIENCE) -> None:
        """Drain underfull bins, the emptiest first, until the bound is met or ``patience`` steps close no bin.

        Every step raises the sum of squared fills, so the search can't go round in circles.
        A bin that nothing can be done with is left until a bin has been closed.
        """
        least, n = -(-int(self.lengths.sum()) // self.size), sum(map(bool, self.members))
        left, stuck = patience, np.zeros(len(self.fill), bool)
        while left and n > least:
            open_ = np.where((self.fill > 0) & (self.fill < self.size) & ~stuck, self.fill, self.size)
            b = int(open_.argmin())
            if open_[b] == self.size:
                return
            left -= 1
            if not self._improve(b):
                stuck[b] = True
            elif not self.members[b]:
                n, left = n - 1, patience
                stuck[:] = False


def pack_group(lengths: list[int], size: int) -> list[list[int]]:
    """Bins (lists of places in ``lengths``)."""
    bins = Bins(lengths, size)
    bins.search()
    return [m for m in bins.members if m]


def pack(pieces: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset; lengths are 1 to ``size``."""
    n = pieces.where(F.col("length") < size).count()
    groups = max(1, -(-n // group))
    # equal rows too go to different groups: a written piece has a number of its own
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length", F.monotonically_increasing_id()), F.lit(groups)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="g").sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].tolist()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for k, members in enumerate(pack_group(lengths, size)):
            at = 0
            for i in members:
                sequence[i], offset[i] = k, at
                at += lengths[i]
        # numbers of a group lie in a range of its own
        return pdf.assign(sequence_id=(sequence * groups + key[0]) * 2 + 1, offset=offset)

    part = dealt.where(F.col("length") < size).groupBy("g").applyInPandas(run, schema)
    whole = pieces.where(F.col("length") >= size).withColumn("sequence_id", 2 * F.monotonically_increasing_id())
    return part.unionByName(whole.withColumn("offset", F.lit(0).cast("long")))


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``documents``."""
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(stored(tokenise(docs), "pieces"))
