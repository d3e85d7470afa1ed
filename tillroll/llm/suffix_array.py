"""Exact removal of repeated byte strings by a sparse suffix array.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a
document with a smaller id.  Each window of ``LENGTH`` bytes is known by its
anchor, the position whose next ``GRAM`` bytes have the smallest hash in the
window; equal windows have equal anchors, so only suffixes at anchors have to be
sorted, with the bytes that their windows reach to either side.

* Every task finds the anchors of its texts.  Of equal contexts in a task only
  the ones in the smallest document travel; the others are repeats already.
* Contexts meet by the anchor's hash, in ``PASSES`` passes over the hash space,
  so that a fraction of them is on disk at a time.  There equal contexts become
  one, and the distinct ones are sorted twice: by what follows the anchor and by
  what precedes it, read backwards.  The sort is deep-shallow: multikey
  quicksort on words of eight bytes to a shallow depth, then blind tries for the
  groups that still agree.  Common prefixes of neighbours give, for each window,
  the contexts that have it, and so the smallest document with it.
* Repeated windows go back to their documents as spans.

What a task gets of a frequent string is one context for each segment of input
at most, never one for each document.

Null text counts as empty.  Rows with a null id lose nothing and repeat nothing.
Rows of equal id don't count as each other's earlier document.  Ids are
integers; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

LENGTH, GRAM = 50, 12
REACH = LENGTH - GRAM  # bytes of a window before its anchor, at most
WIDTH = REACH + LENGTH
PASSES = 4
#: Bytes of text a task works on at once; longer texts are worked on in overlapping pieces.
SEGMENT = 8 << 20
#: Windows whose hashes a task holds at once.
STEP = 1 << 18
#: Words of eight bytes that the multikey quicksort looks at.
SHALLOW = 3
_LOW = np.uint64((1 << 24) - 1)


# -- anchors -----------------------------------------------------------------


def _mixed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    h = low * np.uint64(0x9E3779B97F4A7C15)
    h ^= high * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _grams(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``GRAM`` (8 + 4) bytes at each position as two numbers, without a copy."""
    n = len(b) - GRAM + 1
    return np.ndarray((n,), "<u8", b, 0, (1,)), np.ndarray((n,), "<u4", b, 8, (1,))


def _least(b: np.ndarray) -> np.ndarray:
    """For each window, the position of its smallest hash (the leftmost of equal ones)."""
    h = _mixed(*_grams(b))
    h &= ~_LOW
    h |= np.arange(len(h), dtype=np.uint64)
    width = REACH + 1
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < width:
        h = np.minimum(h[: len(h) - (width - span)], h[width - span :])
    h &= _LOW
    return h


def anchors(b: np.ndarray, bounds: np.ndarray, step: int = STEP) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, hash) of each run of windows with one anchor.

    ``bounds``: where each text begins in ``b``, and the end.  Hashes are held for
    ``step`` windows at a time, and four bytes of result for every window.
    """
    n = max(0, len(b) - LENGTH + 1)
    p = np.empty(n, np.int32)
    for a in range(0, n, step):
        z = min(n, a + step)
        p[a:z] = _least(b[a : z + LENGTH - 1])
        p[a:z] += a
    valid = np.ones(n, bool)
    for end in bounds[1:-1]:  # windows that would cross into the next text
        valid[max(0, end - LENGTH + 1) : end] = False
    new = np.ones(n + 1, bool)  # a run begins here, or the windows end
    new[1:n] = (p[1:] != p[:-1]) | (valid[1:] != valid[:-1])
    first = np.nonzero(new[:n] & valid)[0]
    last = np.nonzero(new[1:] & valid)[0]
    p = p[first].astype(np.int64)
    return p, first, last, _mixed(*(x[p] for x in _grams(b))) if len(p) else np.zeros(0, np.uint64)


def contexts(b: np.ndarray, p: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bytes around each anchor that its windows reach, zero elsewhere, and how many there are before and from it."""
    before, after = (p - first).astype(np.uint8), (last + LENGTH - p).astype(np.uint8)
    c = np.lib.stride_tricks.sliding_window_view(np.pad(b, (REACH, LENGTH)), WIDTH)[p]
    place = np.arange(WIDTH, dtype=np.uint8)
    c[(place < REACH - before[:, None]) | (place >= REACH + after[:, None])] = 0
    return c, before, after


def same_rows(c: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For each row the first row that equals it."""
    full = np.zeros((len(c), WIDTH + 8), np.uint8)
    full[:, :WIDTH], full[:, WIDTH], full[:, WIDTH + 1] = c, before, after
    words = full.view("<u8")
    h = np.zeros(len(c), np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    _, first, group = np.unique(h, return_index=True, return_inverse=True)
    head = first[group]
    if not (words == words[head]).all():  # two rows share a hash
        _, first, group = np.unique(full.view(f"V{WIDTH + 8}").ravel(), return_index=True, return_inverse=True)
        head = first[group]
    return head


# -- deep-shallow sorting ----------------------------------------------------


def blind_trie(strings: list[bytes]) -> list[int]:
    """Places of ``strings`` (of one length) in order: inserted one by one into a trie that knows branching bytes only."""
    size = len(strings[0])
    numbers = [int.from_bytes(s) for s in strings]

    def differ(i: int, j: int) -> int:
        x = numbers[i] ^ numbers[j]
        return size if not x else size - (x.bit_length() + 7) // 8

    root: list = [[0]]  # a leaf: [places]; a branch: [depth, {byte: node}]
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while len(node) == 2:  # blind: a missing branch is replaced by any
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = node[0][0]
        d = differ(i, other)
        if d == size:
            node[0].append(i)
            continue
        node = root
        while len(node) == 2 and node[0] < d:
            node = node[1][s[node[0]]]
        if len(node) == 2 and node[0] == d:
            node[1][s[d]] = [[i]]
        else:
            node[:] = [d, {strings[other][d]: list(node), s[d]: [[i]]}]
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if len(node) == 1:
            out.extend(node[0])
        else:
            todo.extend(node[1][c] for c in sorted(node[1], reverse=True))
    return out


def deep_shallow(rows: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the common prefix of each with the one before it in that order."""
    n, size = rows.shape
    padded = np.zeros((n, -(-size // 8) * 8), np.uint8)
    padded[:, :size] = rows
    words = padded.view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)
    for k in range(min(shallow, words.shape[1])):
        tied = np.zeros(n, bool)
        if n > 1:
            equal = group[1:] == group[:-1]
            tied[1:] |= equal
            tied[:-1] |= equal
        at = np.nonzero(tied)[0]
        if not len(at):
            break
        part = order[at]
        part = part[np.lexsort((words[part, k], group[at]))]
        order[at] = part
        new = np.ones(n, bool)
        new[1:] = (group[1:] != group[:-1]) | (words[order[1:], k] != words[order[:-1], k])
        group = np.cumsum(new)
    starts = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0] if n else np.zeros(0, np.int64)
    ends = np.append(starts[1:], n)
    done = min(shallow * 8, size)
    if done < size:
        for a, z in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            part = order[a:z]
            order[a:z] = part[blind_trie([rows[i, done:].tobytes() for i in part])]
    lcp = np.zeros(n, np.int64)
    for a in range(1, n, 1 << 16):
        z = min(n, a + (1 << 16))
        unequal = rows[order[a:z]] != rows[order[a - 1 : z - 1]]
        lcp[a:z] = np.where(unequal.any(axis=1), unequal.argmax(axis=1), size)
    return order, lcp


def repeated_windows(c: np.ndarray, before: np.ndarray, after: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For distinct contexts, whether the window that starts t bytes before the anchor is in a smaller document."""
    n = len(c)
    found = np.zeros((n, REACH + 1), bool)
    order, lcp = deep_shallow(c[:, REACH:])
    near = lcp >= GRAM
    near[:-1] |= lcp[1:] >= GRAM
    live = np.sort(order[near])
    if len(live) < 2:
        return found
    if len(live) < n:
        found[live] = repeated_windows(c[live], before[live], after[live], doc[live])
        return found
    back, back_lcp = deep_shallow(np.ascontiguousarray(c[:, REACH - 1 :: -1] if REACH else c[:, :0]))
    after, before = after.astype(np.int64), before.astype(np.int64)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for t in range(REACH + 1):
        has = (before >= t) & (after >= LENGTH - t)
        right[order] = np.cumsum(lcp < LENGTH - t)
        left[back] = np.cumsum(back_lcp < t)
        at = np.nonzero(has)[0]
        key = right[at] * (n + 1) + left[at]
        by = np.argsort(key)
        key = key[by]
        start = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
        if len(start) == len(key):
            continue
        least = np.repeat(np.minimum.reduceat(doc[at[by]], start), np.diff(np.append(start, len(key))))
        found[at[by], t] = least < doc[at[by]]
    return found


# -- spans -------------------------------------------------------------------


def merged(start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching spans of one owner made one; owners are small numbers."""
    if not len(start):
        return start, end, owner
    by = np.lexsort((start, owner))
    start, end, owner = start[by], end[by], owner[by]
    far = np.maximum.accumulate(end + owner * (1 << 42)) - owner * (1 << 42)
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] > far[:-1])])
    at = np.nonzero(new)[0]
    return start[at], np.append(far[at[1:] - 1], far[-1]), owner[at]


_SHIPPED = ["n", "c", "before", "after", "doc", "occ_context", "occ_text", "occ_start"]
_SHIP_SCHEMA = "bucket int, n int, c binary, before binary, after binary, doc binary, occ_context binary, occ_text binary, occ_start binary"
_SPAN_SCHEMA = "doc_id long, text_key long, a long, z long"


def _ship(turn: int, passes: int, buckets: int, segment: int):
    """Texts to rows of contexts, one for each segment and bucket; a row without contexts holds finished spans."""

    def work(b: np.ndarray, bounds: np.ndarray, ids: np.ndarray, keys: np.ndarray, base: np.ndarray) -> Iterator[pa.RecordBatch]:
        p, first, last, h = anchors(b, bounds)
        mine = (h & np.uint64(passes - 1)) == turn
        p, first, last, h = p[mine], first[mine], last[mine], h[mine]
        if not len(p):
            return
        text = np.searchsorted(bounds, first, "right") - 1
        bucket = ((h >> np.uint64(4)) & np.uint64((1 << 20) - 1)).astype(np.int64) % buckets
        c, before, after = contexts(b, p, first, last)
        head = same_rows(c, before, after)
        doc = ids[text]
        least = np.full(len(p), np.iinfo(np.int64).max)
        np.minimum.at(least, head, doc)
        travels = doc == least[head]
        # a later document of the segment: all its windows here are repeats
        start, end, owner = merged(first[~travels] - bounds[text[~travels]], last[~travels] + LENGTH - bounds[text[~travels]], text[~travels])
        rows = []
        if len(start):
            rows.append((int(bucket[0]), 0, b"", b"", b"", ids[owner].tobytes(), (end + base[owner]).tobytes(), keys[owner].tobytes(), (start + base[owner]).tobytes()))
        occ = np.nonzero(travels)[0]
        heads = np.unique(head[occ])
        by = heads[np.argsort(bucket[heads], kind="stable")]
        number = np.empty(len(p), np.int64)
        occ = occ[np.argsort(bucket[occ], kind="stable")]
        cuts = np.nonzero(np.diff(bucket[by]))[0] + 1
        occ_cuts = np.nonzero(np.diff(bucket[occ]))[0] + 1
        for rep, o in zip(np.split(by, cuts), np.split(occ, occ_cuts)):
            number[rep] = np.arange(len(rep))
            rows.append(
                (
                    int(bucket[rep[0]]), len(rep), c[rep].tobytes(), before[rep].tobytes(), after[rep].tobytes(), least[rep].tobytes(),
                    number[head[o]].tobytes(), keys[text[o]].tobytes(), (first[o] - bounds[text[o]] + base[text[o]]).tobytes(),
                )
            )
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), [pa.int32(), pa.int32(), *[pa.binary()] * 7])], names=["bucket", *_SHIPPED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            bounds = np.cumsum([0, *[len(x[3]) for x in held]])
            ids, keys, base = (np.array([x[k] for x in held], np.int64) for k in range(3))
            yield from work(np.frombuffer(b"".join(x[3] for x in held), np.uint8), bounds, ids, keys, base)

        for batch in batches:
            for i, key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = t.as_py()
                for a in range(0, max(1, len(data) - LENGTH + 1), segment):
                    held.append((i, key, a, data[a : a + segment + LENGTH - 1]))
                    size += len(held[-1][3])
                    if size >= segment:
                        yield from flush()
                        held, size = [], 0
        if held:
            yield from flush()

    return run


def _resolve(t: pa.Table) -> pa.Table:
    """A bucket's contexts to the spans of its occurrences."""
    rows = t.to_pylist()
    out: list[tuple[np.ndarray, ...]] = []
    view = lambda x, kind: np.frombuffer(x, kind)
    for r in rows:
        if not r["n"]:
            out.append((view(r["doc"], np.int64), view(r["occ_text"], np.int64), view(r["occ_start"], np.int64), view(r["occ_context"], np.int64)))
    rows = [r for r in rows if r["n"]]
    if rows:
        c = np.concatenate([view(r["c"], np.uint8) for r in rows]).reshape(-1, WIDTH)
        before, after = (np.concatenate([view(r[k], np.uint8) for r in rows]) for k in ("before", "after"))
        doc = np.concatenate([view(r["doc"], np.int64) for r in rows])
        base = np.cumsum([0, *[r["n"] for r in rows]])
        occ = np.concatenate([view(r["occ_context"], np.int64) + n for r, n in zip(rows, base)])
        key, start = (np.concatenate([view(r[k], np.int64) for r in rows]) for k in ("occ_text", "occ_start"))
        head = same_rows(c, before, after)
        least = np.full(len(c), np.iinfo(np.int64).max)
        np.minimum.at(least, head, doc)
        heads, rep = np.unique(head, return_inverse=True)
        found = repeated_windows(c[heads], before[heads], after[heads], least[heads])
        later = doc[occ] > least[head[occ]]
        o = occ[later]
        out.append((doc[o], key[later], start[later], start[later] + before[o].astype(np.int64) + after[o]))
        some = np.nonzero(~later & found[rep[occ]].any(axis=1))[0]
        which, t_ = np.nonzero(found[rep[occ[some]]])
        at = start[some[which]] + before[occ[some[which]]].astype(np.int64) - t_
        a, z, owner = merged(at, at + LENGTH, which)
        out.append((doc[occ[some[owner]]], key[some[owner]], a, z))
    cols = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in zip(*out)] or [np.zeros(0, np.int64)] * 4
    return pa.table(dict(zip(("doc_id", "text_key", "a", "z"), cols)))


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", passes: int = PASSES, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, text_key, a, z): bytes of each document that go; spans may overlap.  text_key: xxhash64 of the text."""
    spark = docs.sparkSession
    read = docs.where(F.col(doc_id).isNotNull() & (F.octet_length(text) >= LENGTH)).select(
        F.col(doc_id).cast("long"), F.xxhash64(text), F.col(text).cast("binary")
    )
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    turns = []
    for turn in range(passes):
        shipped = read.mapInArrow(_ship(turn, passes, buckets, segment), _SHIP_SCHEMA)
        turns.append(stored(shipped.groupBy("bucket").applyInArrow(_resolve, _SPAN_SCHEMA), "spans"))
    out = turns[0]
    for x in turns[1:]:
        out = out.unionByName(x)
    return out


def _cut(data: bytes, found) -> tuple[bytes, int, int]:
    """Kept bytes, bytes removed and maximal removed runs."""
    if found is None or not len(found):
        return data, 0, 0
    a, z, _ = merged(*np.array([(s["a"], s["z"]) for s in found], np.int64).T, np.zeros(len(found), np.int64))
    ends = [0, *z.tolist()]
    kept = b"".join(data[x:y] for x, y in zip(ends, [*a.tolist(), len(data)]))
    return kept, len(data) - len(kept), len(a)


def _with_spans(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``docs`` with its columns renamed c0, c1 and so on, and the spans of each row's text."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    t, d = (f"c{docs.columns.index(c)}" for c in (text, doc_id))
    found = spans(plain, t, d).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("a", "z")).alias("spans"))
    same = (F.col(d) == F.col("doc_id")) & (F.xxhash64(t) == F.col("text_key"))
    return plain.join(found, same, "left").drop("doc_id", "text_key")


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with repeated bytes cut out of the text; the ends of a character cut in two go with it.

    A column n_chars, if there, is set anew for the texts that were cut.  Null texts stay null.
    """
    schema = docs.schema
    at = docs.columns.index(text)
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *cols, found = b.columns
            texts, found = cols[at].to_pylist(), found.to_pylist()
            new = [t if t is None or not s else _cut(t.encode(), s)[0].decode("utf-8", "ignore") for t, s in zip(texts, found)]
            cols[at] = pa.array(new, pa.string())
            if count is not None:
                old = cols[count].to_pylist()
                cols[count] = pa.array([len(t) if s else n for t, s, n in zip(new, found, old)], cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return _with_spans(docs, text, doc_id).mapInArrow(run, schema)


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = T.StructType(
        [docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept_sha256", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [(t or "").encode("utf-8", "replace") for t in b.column(1).to_pylist()]
            cut = [_cut(t, s) for t, s in zip(data, b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), pa.array([len(t) for t in data], pa.int64()), pa.array([x[1] for x in cut], pa.int64()),
                    pa.array([x[2] for x in cut], pa.int64()), pa.array([hashlib.sha256(x[0]).hexdigest() for x in cut]),
                ],
                names=schema.names,
            )

    return _with_spans(docs, "text", "doc_id").mapInArrow(run, schema)
