"""Phrase mining against a plain count of every phrase, and against its SQL."""

import re
from collections import Counter

import duckdb
import pytest
from tillroll.llm import phrase_mining as pm

from .helpers import documents, folder, odd_rows, rng


def corpus(r, n=900):
    """Texts in three languages with set phrases, bursts in single texts, marks, line ends and odd signs."""
    out = []
    for i in range(n):
        words = [f"w{r.randrange(7)}" for _ in range(r.randrange(30))]
        if i % 2:
            words[5:5] = ["New", "York", "City", "hall"]
        if i % 5 == 0:
            words += ["in", "spite", "of", "it", "all,", "in", "spite"]
        if i == 17:
            words += ["only", "here"] * 90
        text = "".join(w + r.choice([*[" "] * 14, "  ", "\t", ". ", "\n", " \r", "\x0b"]) for w in words)
        out.append((i, text, [None, "en", "und", "de"][i % 4], "s", i))
    return out + odd_rows()[:13] + [out[1]] * 150 + [(None, out[3][1], "en", None, None)] * 30


def brute(rows, least=100, top=2000):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 6):
                c = counts.setdefault(lang, Counter())
                c.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        n, found = totals[lang], []
        frequent = {p: f for p, f in c.items() if f >= least}
        for p, a in frequent.items():
            if len(p) < 2:
                continue
            if any(len(q) > len(p) and f >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, f in frequent.items()):
                continue
            score, cut = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), (c[p[:cut]], c[p[cut:]])))
        for rank, (s, a, p, (x, y)) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n, -s))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    return corpus(rng(8))


def test_against_plain_counts_and_sql(spark, tmp_path, rows):
    root = folder(spark, str(tmp_path), rows)
    expected = brute(rows)
    assert len(expected) > 30 and {x[0] for x in expected} == {"en", "und", "de"}
    assert sorted(map(tuple, pm.op13_phrase_mining(spark, root).collect())) == expected
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{root}/documents.parquet/*.parquet'")
    assert sorted(con.execute(pm.ORACLE).fetchall()) == expected


@pytest.mark.parametrize("one_in, lowered, bits", [(1, 1.0, 16), (1000, 1.0, 16), (3, 0.1, 6)])
def test_any_sample_and_any_filter_give_the_same(spark, rows, monkeypatch, one_in, lowered, bits):
    monkeypatch.setattr(pm, "FILTER_BITS", (1 << max(bits, 15), 1 << max(bits, 15)))  # 2**15: nearly all probes hit something
    docs = documents(spark, rows).repartition(5)
    found = pm.frequent_phrases(docs, least=40, one_in=one_in, lowered=lowered)
    got = {(r.lang, r.phrase): r.f for r in found.where("k > 0").collect()}
    counts = {}
    for _, text, lang, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    key = (lang or "und", " ".join(w[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    assert got == {k: f for k, f in counts.items() if f >= 40}


def test_products_beyond_64_bits(spark):
    frequent = spark.createDataFrame(
        [("en", 0, "", 10**14), ("en", 1, "a", 10**13), ("en", 1, "b", 3 * 10**12), ("en", 2, "a b", 9 * 10**11 + 7)], "lang string, k int, phrase string, f long"
    )
    row = pm.cut_scores(frequent.where("k > 1"), frequent).first()
    assert row["score"] == 1000 * (9 * 10**11 + 7) * 10**14 // (10**13 * 3 * 10**12)


def test_ranks_and_longer_phrases(spark):
    scored = spark.createDataFrame([("en", p, a, s) for p, a, s in [("b", 5, 9), ("a", 5, 9), ("c", 6, 9), ("é", 1, 1), ("z", 1, 1)]], "lang string, phrase string, a long, score long")
    got = pm.ranked(scored, top=4, salts=3).orderBy("rank").collect()
    assert [(r["rank"], r["phrase"]) for r in got] == [(1, "c"), (2, "a"), (3, "b"), (4, "z")]
    phrases = spark.createDataFrame([("en", 2, "a b", 10), ("en", 3, "a b c", 9), ("de", 3, "a b c", 10), ("en", 2, "b c", 9)], "lang string, k int, phrase string, f long")
    assert sorted((r.lang, r.phrase) for r in pm.maximal(phrases).collect()) == [("de", "a b c"), ("en", "a b"), ("en", "a b c")]
    assert sorted((r.lang, r.phrase) for r in pm.maximal(phrases, 80).collect()) == [("de", "a b c"), ("en", "a b c")]


def test_empty_table(spark):
    assert pm.collocations(documents(spark, [])).collect() == []
    assert pm.collocations(documents(spark, [(1, None, None, None, None)])).collect() == []
