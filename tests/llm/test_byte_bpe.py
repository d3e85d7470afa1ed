import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tillroll.llm import byte_bpe as B

from .helpers import documents, folder, odd_rows, rng


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(P.path(B.VOCABULARY))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_the_library(spark, tmp_root, reference):
    rows = odd_rows()
    got = B.op1_byte_bpe(spark, folder(spark, tmp_root, rows)).collect()
    want = []
    for r in rows:
        text = r[1] or ""
        ids = reference.encode_ordinary(text)
        want.append(
            (r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        )
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_table(spark, tmp_root):
    assert B.op1_byte_bpe(spark, folder(spark, tmp_root, [])).count() == 0


def test_folds_agree_with_the_library(spark, ranks, reference):
    """The fold and that of long pieces give the same ids."""
    r = rng(1)
    words = ["a" * n for n in (1, 2, 7, 61, 63, 130)] + ["".join(r.choice("abcehinorst é") for _ in range(n)) for n in range(1, 40)]
    words += ["".join(r.choice("ab") for _ in range(600)), "the" * 300, "=" * 700]
    vocabulary = B.Vocabulary(spark, ranks)
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    got = B.project(frame, "ids", lambda ranks: B.Merges(ranks).fold(F.col("w").cast("binary")), ranks=vocabulary.ranks)
    for row in got.collect():
        assert row.ids == reference._encode_single_piece(row.w.encode()), row.w


def test_decode_is_the_inverse(spark, ranks):
    vocabulary = B.Vocabulary(spark, ranks)
    docs = documents(spark, odd_rows(), clash=True).drop("ids")
    back = B.decode(B.encode(docs, vocabulary, head=50, one_in=1), vocabulary)
    for row in back.select("text", "bytes").collect():
        assert bytes(row.bytes) == (row.text or "").encode()


def test_something_else_is_made_of_each_piece(spark, ranks, reference):
    """What ``each`` makes, of pieces in the head and outside it, is joined in the order of the text."""
    vocabulary = B.Vocabulary(spark, ranks)
    texts = [None, "", "the cat sat", "the cat zqxjkv zqxjkv\x00 the \u00fc\U0001f642", "the cat"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = B.encode(docs, vocabulary, head=3, one_in=1, each=lambda ids, **_: F.size(ids), digest=lambda found: found)
    want = {t: [len(reference._encode_single_piece(p)) for p in regex.findall(P.PATTERN, t or "")] for t in texts}
    assert {r.text: r.ids for r in got.collect()} == want


def test_bytes_without_a_rank(spark):
    """A vocabulary without all single bytes: they still take part in joins."""
    vocabulary = B.Vocabulary(spark, {b"ab": 0, b"abc": 1, b"c": 2, b"bc": 3})
    frame = spark.createDataFrame([("abcab",), ("xab",), ("cc",), ("bbc",)], "w string")
    got = B.project(frame, "ids", lambda ranks: B.Merges(ranks).fold(F.col("w").cast("binary")), ranks=vocabulary.ranks)
    assert {r.w: r.ids for r in got.collect()} == {"abcab": [1, 0], "xab": [B.NONE, 0], "cc": [2, 2], "bbc": [B.NONE, 3]}
