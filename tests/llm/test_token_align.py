"""Alignment of two tokenizers, against whole-text encoding and a byte-by-byte count."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tillroll.llm import token_align as ta

from .helpers import documents, folder, odd_rows, prose, rng

TRICKY = [
    "a  b\n c\tx  \n\n y\r\nz",
    "\nNext line\n",
    "   ",
    "\n",
    "<|endoftext|> hi <s> </s> <unk> <0x41>",
    "under▁score",
    "nul\x00 \x1c\x1d sep\x85arators here and 　there",
    "é é ﬁ Å 漢字 🙂👩‍👩‍👧 नमस्ते ไทย",
    "don't we'll I'D  they're'd",
    "if (x) {\r\n  return;\r\n} */\r",
    "x" * 5000,
    "Nd," * 400,
]


def whole(text):
    """Tokens of the whole text at once, as (id, bytes)."""
    t = ta.tokenizers()
    if not text:
        return None
    a = t.a.encode(" " + text, add_special_tokens=False).ids
    b = t.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(t.bytes_a[i] for i in a) != raw or b"".join(t.bytes_b[i] for i in b) != raw:
        return None
    return [(i, t.bytes_a[i]) for i in a], [(i, t.bytes_b[i]) for i in b]


def brute(rows):
    """Expected rows by marking, byte for byte, which token covers it."""
    docs, held = [], Counter()
    for doc_id, text in rows:
        both = whole(text)
        if both is None:
            docs.append((doc_id, None))
            continue
        owner = [[k for k, (_, s) in enumerate(x) for _ in s] for x in both]
        links = sorted(set(zip(*owner)))
        ends = [set(np.cumsum([len(s) for _, s in x]).tolist()) for x in both]
        cuts, groups, last = sorted(ends[0] & ends[1]), [], 0
        for c in cuts:
            parts = [[str(x[k][0]) for k in sorted(set(o[last:c]))] for x, o in zip(both, owner)]
            groups.append(parts)
            last = c
        pairs = [(both[0][i][0], both[1][j][0]) for i, j in links]
        held.update(set(pairs))
        docs.append((doc_id, (len(both[0]), len(both[1]), groups, pairs)))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, x in docs:
        if x is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        n_a, n_b, groups, pairs = x
        text = ";".join(",".join(a) + "|" + ",".join(b) for a, b in groups)
        out.append((
            doc_id, n_a, n_b, len(groups), len(pairs), sum(held[p] == best[p[0]] for p in pairs), sum(held[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest(), sum(len(a) * len(b) for a, b in groups),
        ))
    return sorted(out, key=str)


def test_whole_texts_against_bytes(spark, tmp_path, monkeypatch):
    rows = odd_rows()
    rows += [(900 + i, x, None, None, None) for i, x in enumerate(TRICKY)]
    root = folder(spark, str(tmp_path), rows)
    expected = brute([(r[0], r[1]) for r in rows])
    assert sorted(map(tuple, ta.op11_token_align(spark, root).collect()), key=str) == expected
    assert sum(r[1] == 0 for r in expected) >= 4


def test_small_blocks_give_the_same(spark):
    r = rng(3)
    rows = [(i, prose(r, 40, 60) if i % 3 else TRICKY[i % len(TRICKY)], None, None, None) for i in range(60)]
    texts = [(x[0], x[1]) for x in rows]
    t = ta.tokenizers()
    one, many = ta.Block(t), []
    whole_block = one.read([x for _, x in texts])
    for _, x in texts:
        block = ta.Block(t)
        many += block.read([x])
    assert [(a[0], a[3]) for a in whole_block] == [(a[0], a[3]) for a in many]
    assert sorted(map(tuple, ta.align(documents(spark, rows).repartition(7)).collect()), key=str) == brute(texts)


@pytest.mark.parametrize("step", [1, 7, 1 << 22])
def test_products_against_dense(monkeypatch, step):
    monkeypatch.setattr(ta, "STEP", step)
    r = np.random.default_rng(4)
    for _ in range(20):
        a, b = (r.random((6, 9)) < 0.4).astype(int), (r.random((9, 5)) < 0.4).astype(int)

        def csr(m):
            return ta.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1])

        dense = np.zeros((6, 5), int)
        for rows, columns, times in csr(a).multiply(csr(b)):
            dense[rows, columns] += times
        assert (dense == a @ b).all()
        back = csr(a).transpose()
        assert (back.starts == csr(a.T).starts).all() and (back.columns == csr(a.T).columns).all()
        assert (csr(a).products(csr(b)) == (a @ b).sum(1)).all()


def test_alignment_itself(spark):
    texts = [(1, "tokenizers differ, don't they?"), (2, None), (3, "漢字 🙂"), (4, "a▁b")]
    rows = {r["doc_id"]: r for r in ta.alignments(documents(spark, [(i, x, None, None, None) for i, x in texts], clash=True)).collect()}
    t = ta.tokenizers()
    for i, x in texts:
        both = whole(x)
        assert rows[i]["a_ids"] == ([k for k, _ in both[0]] if both else [])
        assert rows[i]["b_ids"] == ([k for k, _ in both[1]] if both else [])
        if both:
            x = ta.align_stretches(t.stretches(x), t)
            assert sum(len(a) for a, _ in ta.shared_links(x)) == x.shared.sum()


def test_empty_table(spark):
    assert ta.align(documents(spark, [])).collect() == []
    assert ta.align(documents(spark, [(1, None, None, None, None), (1, None, None, None, None)])).count() == 2
