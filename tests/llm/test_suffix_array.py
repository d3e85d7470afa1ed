import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import suffix_array as S

from .helpers import documents, folder, odd_rows, prose, rng


def brute(rows, length=50):
    first = {}
    for i, t in sorted((r[0], (r[1] or "").encode()) for r in rows if r[0] is not None):
        for s in range(len(t) - length + 1):
            first.setdefault(t[s : s + length], i)
    out = []
    for r in rows:
        t = (r[1] or "").encode()
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1 if r[0] is not None else 0):
            if first[t[s : s + length]] < r[0]:
                gone[s : s + length] = True
        runs = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((r[0], len(t), int(gone.sum()), int((runs == 1).sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def planted(seed=2):
    """Passages around the length, at either end, overlapping, with bytes of many-byte characters beside them."""
    r = rng(seed)
    passages = [prose(r, 40)[:n] for n in (49, 50, 51, 60, 90, 130)]
    rows = []
    for i in range(60):
        parts = [prose(r, r.randrange(0, 30), 3000) for _ in range(3)]
        for k in range(2):
            parts.insert(r.randrange(4), r.choice(passages) if r.random() < 0.6 else "é" * r.randrange(40))
        rows.append((r.randrange(40), "".join(parts), "en", "s", 0))
    return rows


def test_query_equals_brute_force(spark, tmp_root):
    rows = odd_rows() + [(100 + r[0], *r[1:]) for r in planted()]
    rows = list({r[:2]: r for r in rows}.values())
    got = S.op2_suffix_array(spark, folder(spark, tmp_root, rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_long_texts_in_pieces(spark):
    rows = [r for r in planted(9)]
    rows = list({r[:2]: r for r in rows}.values())
    for segment in (60, 333, 1 << 20):
        found = S.spans(documents(spark, rows), passes=2, segment=segment).collect()
        gone = {}
        for f in found:
            gone.setdefault(f.doc_id, set()).update((f.text_key, p) for p in range(f.a, f.z))
        want = {}
        for i, _, n, _, _ in brute(rows):
            want[i] = want.get(i, 0) + n
        assert {k: len(v) for k, v in gone.items()} == {k: v for k, v in want.items() if v}


def test_removing_cuts_whole_characters(spark):
    passage = "abcdefghij" * 6
    rows = [(1, passage, "en", "s", 60), (2, "ééé" + passage + "漢", "en", "s", 64), (None, passage, None, None, None), (3, None, None, None, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in S.remove_repeats(documents(spark, rows, clash=True)).collect()}
    assert got == {1: (passage, 60), 2: ("ééé漢", 4), None: (passage, None), 3: (None, None)}


def test_empty_table(spark, tmp_root):
    assert S.op2_suffix_array(spark, folder(spark, tmp_root, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=26, max_size=26).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=40))
def test_blind_trie_sorts(strings):
    assert [strings[i] for i in S.blind_trie(strings)] == sorted(strings)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=50, max_size=50).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=30), st.integers(0, 7))
def test_deep_shallow_sorts_with_common_prefixes(strings, shallow):
    rows = np.frombuffer(b"".join(strings + strings[:2]), np.uint8).reshape(-1, 50)
    order, lcp = S.deep_shallow(rows, shallow)
    out = [rows[i].tobytes() for i in order]
    assert out == sorted(out)
    for k in range(1, len(out)):
        want = next((p for p in range(50) if out[k][p] != out[k - 1][p]), 50)
        assert lcp[k] == want


def test_anchors_are_the_same_for_any_step():
    r = np.random.default_rng(3)
    for n, letters in ((0, 2), (49, 2), (50, 2), (51, 2), (4000, 1), (4000, 3)):
        b = r.integers(97, 97 + letters, n).astype(np.uint8)
        bounds = np.sort(np.concatenate([[0, n], r.integers(0, n + 1, 5)]))
        whole = S.anchors(b, bounds)
        for step in (1, 37, 1000):
            assert all((x == y).all() for x, y in zip(whole, S.anchors(b, bounds, step), strict=True))
