"""The toxicity classifier: its n-grams against plain ones, its counts against SQL, its answers against planted texts."""

import numpy as np
import pytest
from tillroll.llm import toxicity as tx

from .helpers import documents, odd_rows, prose, rng

INSULTS = {"en": ["grobnik", "slimewit"], "de": ["schnörpf", "dödelix"]}


def planted(n=700):
    r = rng(2)
    rows, labels = [], []
    for i in range(n):
        lang = ["en", "de"][i % 2]
        words = prose(r, r.randrange(5, 160)).split()
        toxic = i % 5 == 0
        for _ in range(r.randrange(1, 4) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(INSULTS[lang]).upper() if i % 3 else r.choice(INSULTS[lang]) + "er!!")
        rows.append((i, " ".join(words), lang, "s", i))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("toxic"))
    rows, labels = planted()
    long = " ".join(["w1 w2 w3"] * 20_000)
    extra = [(5000 + i, t, None, None, None) for i, t in enumerate([None, "", " \n", "123 !!", long, long + " grobnik slimewit grobniker"])]
    documents(spark, [*rows, *extra, rows[5], (None, rows[0][1], None, None, None)], clash=True).repartition(3).write.parquet(f"{root}/documents.parquet")
    marks = [*labels, (3, 1), (3, 0), (None, 1), (7, None)]
    spark.createDataFrame(marks, "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    return root, dict(labels)


def test_planted_texts_are_caught(spark, tables):
    root, truth = tables
    out = tx.op12_toxicity(spark, root).collect()
    assert len(out) == 700 + 6 + 2
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 150
    toxic = [r["predicted"] for r in held if truth[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not truth[r["doc_id"]]]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    by_id = {r["doc_id"]: r for r in out}
    assert [by_id[5000 + i]["predicted"] for i in range(6)] == [0, 0, 0, 0, 0, 1]
    assert len({by_id[5000 + i]["score"] for i in range(4)}) == 1  # no words, no features


def plain_grams(word):
    w = f"\x02{word}\x03"
    return {w[i : i + n] for n in range(3, 7) for i in range(len(w) - n + 1)} | {f"whole {word}"}


def test_ngrams_against_plain_ones():
    texts = [None, "", "Ab abc ABC äöü", "x", "漢字 🙂 don't", "a" * 3000, "one_two3three"]
    numbers = {}
    for t, g in zip(texts, tx.Reader()(texts)):
        words = {w for w in tx._WORD.findall((t or "").lower())}
        want = set().union(*map(plain_grams, words)) if words else set()
        assert len(set(g.tolist())) == len(g) and abs(len(g) - len(want)) <= 1  # hashes may meet
        for w in words:
            numbers[w] = set(next(tx.Reader()([w])).tolist())
            assert numbers[w] <= set(g.tolist())
    wanted = np.array(sorted(numbers["abc"]), np.int32)
    places = [set(wanted[p].tolist()) for p in tx.Reader(wanted)(texts)]
    assert places[2] == numbers["abc"] and places[0] == set()


def test_blocks_and_forgetting_change_nothing(monkeypatch):
    texts = [r[1] for r in planted(60)[0]]
    whole = [set(g.tolist()) for g in tx.Reader()(texts)]
    wanted = np.array(sorted(whole[0] | whole[7]), np.int32)
    kept = [sorted(g.tolist()) for g in tx.Reader(wanted)(texts)]
    monkeypatch.setattr(tx, "BLOCK", 300)
    monkeypatch.setattr(tx, "KNOWN", 50)
    assert [set(g.tolist()) for g in tx.Reader()(texts)] == whole
    assert [sorted(g.tolist()) for g in tx.Reader(wanted)(texts)] == kept


def test_counts_and_scale(spark):
    rows = [("bad dog", 1), ("bad cat", 1), ("good dog", 0), (None, 0), ("bad bad", 0)]
    found = {r["g"]: (r["pos"], r["neg"]) for r in tx.gram_counts(spark.createDataFrame(rows, "x string, y int").repartition(2)).collect()}
    assert found[-1] == (2, 3)
    assert all(found[int(g)][0] == 2 and found[int(g)][1] == 1 for g in next(tx.Reader()(["bad"])))
    assert np.isclose(tx.log_ratio(2, 1, 2, 3), np.log(3 / 4) - np.log(2 / 5))


def test_without_both_classes(spark):
    docs = documents(spark, odd_rows())
    for labels in ([], [(i, 0) for i in range(20)], [(None, 1), (1, None)]):
        marks = spark.createDataFrame(labels, "doc_id long, toxic int")
        out = tx.score(docs, tx.train(docs, marks), ["doc_id"])
        assert {(r["score"], r["predicted"]) for r in out.collect()} == {(0.0, 0)} and out.count() == docs.count()
    assert tx.score(documents(spark, []), tx.train(documents(spark, []), marks), ["doc_id"]).collect() == []
