import pytest

from pyspark.sql import functions as F

import corpus_pipeline as C
from tillroll.llm import best_fit, quality_rules, sim_hash, suffix_array
from tillroll.llm.common import let, stored, table

from .helpers import folder, odd_rows, rng
from .test_best_fit import check
from .test_language_id import rows as language_rows
from .test_sim_hash import slow_components, slow_fingerprint

STOP = "the of and to in a is that for it".split()


def rows():
    r = rng(6)
    out = [(i, " ".join([t, *(r.choice(STOP) for _ in range(12))]), lang, s, n) for i, t, lang, s, n in language_rows(150)]
    out += [(300 + i, out[i][1], *out[i][2:]) for i in range(20)]  # copies
    passage = out[0][1][:80]
    out += [(400 + i, out[40 + i][1] + " and also " + passage, *out[40 + i][2:]) for i in range(5)]
    return out + [(500 + (r_[0] or 0), *r_[1:]) for r_ in odd_rows()]


def test_stages_in_turn(spark, tmp_root):
    assert [n for n, _ in C.STAGES] == ["language_id", "quality_rules", "sim_hash", "suffix_array", "best_fit"]
    docs = table(spark, folder(spark, tmp_root, rows(), clash=False), "documents")
    seen = {}
    for name, stage in C.STAGES:
        before = docs
        docs = stored(stage(spark, before, tmp_root), f"test-{name}")
        seen[name] = (before.collect(), docs.collect())
        if name != "best_fit":
            assert docs.columns == before.columns

    taken, kept = seen["language_id"]
    assert all(r.text and any(map(str.isalpha, r.text)) for r in kept)
    assert {r.doc_id for r in kept} >= set(range(150))
    model = C.language_id.train(spark.createDataFrame(taken).where(~C.language_id.held_out()))
    found, _ = C.language_id.classify(model, [r.text for r in kept])
    assert [r.lang for r in kept] == list(found)
    assert {(r.doc_id, r.text, r.source, r.n_chars) for r in kept} <= {(r.doc_id, r.text, r.source, r.n_chars) for r in taken}
    taken, kept = seen["quality_rules"]
    judged = let(quality_rules.measures(F.col("text")), lambda m: quality_rules.verdict(m)[1])
    verdicts = {r.doc_id: r.kept for r in spark.createDataFrame(taken).select("doc_id", judged.alias("kept")).collect()}
    assert {r.doc_id for r in kept} == {i for i, k in verdicts.items() if k}
    taken, kept = seen["sim_hash"]
    groups = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in taken])
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in groups})
    taken, kept = seen["suffix_array"]
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in taken)
    assert sum(len(r.text) for r in kept) < sum(len(r.text) for r in taken)
    taken, pieces = seen["best_fit"]
    assert sorted({r.doc_id for r in pieces}) == sorted(r.doc_id for r in taken)
    check(pieces)


@pytest.mark.parametrize("data", [[], [(1, None, None, None, None), (None, "", None, None, None)]])
def test_nothing_to_keep(spark, tmp_root, data):
    assert C.run(spark, folder(spark, tmp_root, data)).count() == 0
