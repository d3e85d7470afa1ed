import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm import best_fit as B

from .helpers import documents, folder, odd_rows, rng


def check(pieces, size=1024):
    bins = {}
    for r in pieces:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return len(bins)


def test_query_pieces_and_ids(spark, tmp_root):
    rows = odd_rows()
    marked = ["<|endoftext|> hi", "a <|endoftext|>\n b", "x  <|endoftext|>  y<|endoftext|><|endoftext|>", "<|endoftext|", " \u3000 z\t\n", "e  "]
    rows += [(800 + i, t, None, None, None) for i, t in enumerate(marked)]
    got = B.op10_best_fit(spark, folder(spark, tmp_root, rows)).collect()
    assert check(got) <= -(-sum(r.length for r in got) // 1024) + 1
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [2]
        cut = len(ids) % 1024 or min(1024, len(ids))
        starts = [0, *range(cut, len(ids), 1024)]
        for k, (a, z) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((r[0], k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())))
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(map(str, want))


def test_many_groups(spark):
    r = rng(1)
    rows = [(i, 0, 0, r.randint(1, 1024), i) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = B.pack(frame, group=100).collect()
    assert len(got) == 900
    assert check(got) <= -(-sum(x[3] for x in rows) // 1024) * 1.06 + 9


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_groups_are_packed_whole(lengths):
    bins = B.pack_group(lengths, 64)
    assert sorted(i for m in bins for i in m) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in m) <= 64 for m in bins)


@pytest.mark.parametrize("seed", range(4))
def test_search_closes_bins_and_raises_squares(seed):
    r = rng(seed)
    lengths = [r.choice([341, 342, 343, 512, 513, 170, 171]) for _ in range(1500)]
    bins = B.Bins(lengths, 1024)
    before, squares = sum(map(bool, bins.members)), int((bins.fill**2).sum())
    bins.search()
    assert sum(map(bool, bins.members)) < before and int((bins.fill**2).sum()) > squares
    assert [sum(lengths[i] for i in m) for m in bins.members] == bins.fill[: len(bins.members)].tolist()


def test_search_comes_near_the_bound_where_best_fit_does_not():
    r = rng(1)
    lengths = [r.randint(260, 419) for _ in range(3000)]
    least = -(-sum(lengths) // 1024)
    bins = B.Bins(lengths, 1024)
    assert len(bins.members) > 1.1 * least
    assert len(B.pack_group(lengths, 1024)) <= 1.04 * least


def offers_by_force(lengths):
    one = {x for x in lengths}
    return one | {x + y for k, x in enumerate(lengths) for y in lengths[k + 1 :]}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=30))
def test_offers_are_all_lengths_of_one_or_two_pieces(lengths):
    bins = B.Bins(lengths, 400)
    assert len(bins.members) == 1
    offers = bins._offers(0)
    assert set(offers) == offers_by_force(lengths)
    assert all(len(set(give)) == len(give) and sum(lengths[i] for i in give) == length for length, give in offers.items())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=2, max_size=40))
def test_a_step_is_the_best_of_all_exchanges(lengths):
    bins = B.Bins(lengths, 64)
    open_ = [b for b, m in enumerate(bins.members) if bins.fill[b] < 64]
    if not open_:
        return
    b = min(open_, key=lambda b: (bins.fill[b], b))
    fill, best = bins.fill.tolist(), 0
    for o in open_:
        if o != b and fill[o] >= fill[b]:
            for give in offers_by_force([lengths[i] for i in bins.members[b]]):
                for back in [0, *(lengths[i] for i in bins.members[o])]:
                    if back < give <= back + 64 - fill[o]:
                        best = max(best, (fill[o] + give - back) ** 2 + (fill[b] - give + back) ** 2 - fill[o] ** 2 - fill[b] ** 2)
    squares = int((bins.fill**2).sum())
    assert bins._improve(b) == (best > 0)
    assert int((bins.fill**2).sum()) - squares == best
    assert sorted(i for m in bins.members for i in m) == list(range(len(lengths)))


def test_empty_table(spark, tmp_root):
    assert B.op10_best_fit(spark, folder(spark, tmp_root, [])).count() == 0


def test_equal_rows_go_to_different_groups(spark, tmp_root):
    frame = spark.createDataFrame([(None, 0, 0, 500, 1)] * 400, "doc_id long, piece int, start long, length long, ids_crc32 long")
    frame.write.parquet(f"{tmp_root}/pieces")
    got = B.pack(spark.read.parquet(f"{tmp_root}/pieces"), group=50).collect()
    assert check(got) <= 200 + 8
    assert len({x.sequence_id // 2 % 8 for x in got}) == 8  # the group is the rest by their number


def test_every_code_point_and_marker_as_the_json_gives():
    t, encode = Tokenizer.from_file(P.path("byte_bpe_50k.json")), B.Encoder()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b{c}{c}1{c} {c} x" for c in points[i : i + 400]) for i in range(0, len(points), 400)]
    texts += [r[1] or "" for r in odd_rows()] + ["b <|endoftext|> c", "d", "<|endoftext|>", " \n<|endoftext|>\n\n e  "]
    for x, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert encode(x).tolist() == e.ids, hex(ord(x[1]))
