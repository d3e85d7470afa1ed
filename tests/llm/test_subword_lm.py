import math
import re
import zlib
from collections import Counter

import pytest

from tillroll.llm import subword_lm as S

from .helpers import documents, folder, odd_rows


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [S.END]


def segmentations(word, log, byte):
    """Log weights of all segmentations, one by one."""
    if not word:
        yield 0.0
    for j in range(1, len(word) + 1):
        w = log.get(word[:j])
        if w is None and j == 1:
            w = byte * len(word[0].encode())
        if w is not None:
            for rest in segmentations(word[j:], log, byte):
                yield w + rest


@pytest.mark.parametrize("word", ["a", "the", "hello", "straße", "漢字x", "!!", "w12"])
def test_lattice_sums_all_segmentations(word):
    m = S.lattice()
    want = math.log10(math.fsum(math.exp(x) for x in segmentations("▁" + word, m.log, m.byte)))
    assert m.word(word) == pytest.approx(want, rel=1e-12)


def test_weights_are_a_distribution():
    m = S.lattice()
    total = sum(math.exp(x) for x in m.log.values()) + 256 * math.exp(m.byte) + 10**m.end
    assert total == pytest.approx(1.0, rel=1e-9)


@pytest.mark.parametrize("head", [3, 50_000])
def test_query_equals_brute_force(spark, tmp_root, head, monkeypatch):
    rows = odd_rows()
    root = folder(spark, tmp_root, rows)
    monkeypatch.setattr(S, "HEAD", head)
    monkeypatch.setattr(S.score, "__defaults__", ("text", head))
    got = S.op5_subword_lm(spark, root).collect()
    held = lambda r: zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 1
    c = Counter(w for r in rows if not held(r) for w in tokens(r[1]))
    total, distinct = sum(c.values()), len(c)
    seen = 1 - min(max(sum(x == 1 for x in c.values()) / total, 1e-6), 0.5)
    m = S.lattice()
    want = []
    for r in rows:
        t = tokens(r[1])
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        score = sum(S.mixed(c[w], total, seen, m.end if w == S.END else m.word(w)) for w in t)
        want.append((str(r[0]), held(r), len(t), sum(w in c for w in t), total, base, score))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_no_training_rows_and_empty_table(spark, tmp_root):
    docs = documents(spark, [(1, "some words", "en", "s", 1), (2, None, None, None, None)])
    got = S.score(docs, S.word_counts(docs.limit(0)), ["doc_id"]).collect()
    assert all(r.train_tokens in (0, None) or r.train_tokens >= 0 for r in got) and all(math.isfinite(r.score) for r in got)
    assert S.op5_subword_lm(spark, folder(spark, tmp_root, [])).count() == 0
