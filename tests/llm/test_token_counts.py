import numpy as np
import pytest

from tillroll.llm import token_counts as S
from tillroll.llm.best_fit import encoder

from .helpers import documents, folder, odd_rows


@pytest.mark.parametrize("block", [1, 7, 64, S.BLOCK])
def test_counts_follow_the_documents(spark, tmp_root, block):
    docs = documents(spark, odd_rows(), clash=True).coalesce(1)
    S.write_token_files(docs, tmp_root)
    got = S.count_tokens(spark, tmp_root, block=block if block > 1 else 2).orderBy("file", "doc_no").collect()
    want = [len(encoder().encode_ordinary(r.text or "")) for r in docs.select("text").collect()]
    assert [r.n_tokens for r in got] == want
    assert [r.start for r in got] == [sum(want[:k]) + k for k in range(len(want))]
    assert all(r.closed for r in got) and [r.doc_no for r in got] == list(range(len(want)))


@pytest.mark.parametrize("block", [2, 3, 5, 1000])
def test_any_flat_file(spark, tmp_path, block):
    """Separators at block borders, one after another, at the start; an open end; an odd byte; an empty file."""
    end = 9
    ids = [[9, 1, 2, 9, 9, 3, 4, 5, 6, 7, 9, 1], [1, 2, 3, 4, 5, 6, 7, 8], [9] * 6, [], [1, 9]]
    for k, x in enumerate(ids):
        (tmp_path / f"f{k}").write_bytes(np.array(x, "<u2").tobytes() + (b"\x09" if k == 1 else b""))
    got = S.count_tokens(spark, str(tmp_path), end, block).orderBy("file", "doc_no").collect()
    want = []
    for k, x in enumerate(ids):
        start = 0
        for at, v in enumerate([*x, None]):
            if v == end or (v is None and start < len(x)):
                want.append((k, start, at - start, v == end))
                start = at + 1
    assert [(int(r.file[-1]), r.start, r.n_tokens, r.closed) for r in got] == want


def test_query_and_empty_table(spark, tmp_root):
    rows = odd_rows()
    got = S.op8_token_counts(spark, folder(spark, tmp_root, rows)).collect()
    want = sorted(len(encoder().encode_ordinary(r[1] or "")) for r in rows)
    assert sorted(r.n_tokens for r in got) == want


def test_empty_table(spark, tmp_root):
    assert S.op8_token_counts(spark, folder(spark, tmp_root, [])).count() == 0
