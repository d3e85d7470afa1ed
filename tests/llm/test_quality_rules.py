import re
from collections import Counter

import duckdb

from tillroll.llm import quality_rules as Q

from .helpers import documents, folder, odd_rows


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(w)
    return (
        n,
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


ROWS = odd_rows() + [
    (200, "a b c d e f g h a b c d e f g h", None, None, 0),
    (201, "a b c d e f g h a b c d e f g", None, None, 0),
    (202, "a a a a a a a a a", None, None, 0),
    (203, "a\x0bb\x0cc\rd\te f line\nline\n\nline\r\nline\r\n#*$%&|<>", None, None, 0),
    (204, " ".join(f"the{i} of and to" for i in range(30)), None, None, 0),
    (205, " ".join(f"v{i} %%% ### to" for i in range(30)), None, None, 0),
]


def test_counts_equal_brute_force(spark, tmp_root):
    got = Q.op3_quality_rules(spark, folder(spark, tmp_root, ROWS)).collect()
    want = [(r[0], *brute(r[1])) for r in ROWS]
    assert sorted(str(tuple(r)[:7]) for r in got) == sorted(map(str, want))
    kept = {r.doc_id: r.kept for r in got}
    assert kept[204] and not kept[205] and not kept[0]


def by_sql(root):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{root}/documents.parquet/*.parquet'")
    return con.execute(Q.ORACLE).fetchall()


def test_sql_agrees(spark, tmp_root):
    rows = list({r[0]: r for r in ROWS if r[0] is not None and "\x00" not in (r[1] or "")}.values())
    root = folder(spark, tmp_root, rows)
    assert sorted(map(tuple, Q.op3_quality_rules(spark, root).collect())) == sorted(by_sql(root))


def test_keep_returns_the_columns_and_runs_no_python(spark):
    docs = documents(spark, ROWS, clash=True)
    kept = Q.keep(docs)
    assert kept.columns == docs.columns
    assert 204 in [r.doc_id for r in kept.collect()]
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark, tmp_root):
    assert Q.op3_quality_rules(spark, folder(spark, tmp_root, [])).count() == 0


RU = "быстрая лиса прыгает через ленивую собаку а потом бежит домой по узкой тропе мимо старого дома где живёт её добрая хозяйка {}"
PL = "szybki lis przeskoczył nad leniwą śpiącą łanią potem pobiegł wąską ścieżką obok starego młyna gdzie mieszkał żółty gęsi król {}"
ID = "rubah cokelat cepat melompati anjing malas lalu pulang lewat jalan sempit dekat rumah tua tempat tinggal pemilik baik hati sekali {}"
SPAM = "cheap shoes online discount offer best price quality brand sale deal shop buy now free delivery worldwide store outlet men {}"


def test_stop_words_bind_only_the_listed_languages(spark, tmp_root):
    rows = [(i, t.format(i), lang, None, 0) for i, (t, lang) in enumerate(
        [(RU, "ru"), (RU, None), (RU, "en"), (PL, "pl"), (PL, None), (ID, "id"), (ID, "id-ID"), (SPAM, "en"), (SPAM, "en-US"), (SPAM, None), (SPAM, "und")]
    )]
    root = folder(spark, tmp_root, rows)
    found = Q.op3_quality_rules(spark, root).collect()
    kept = {r.doc_id for r in found if r.kept}
    assert kept == set(range(7))
    assert sorted(map(tuple, found)) == sorted(by_sql(root))
    docs = documents(spark, rows, clash=True)
    assert {r.doc_id for r in Q.keep(docs).collect()} == kept
    assert {r.doc_id for r in Q.keep(docs.drop("lang")).collect()} == {0, 1, 2, 3, 4}
