"""Small tables for the training-data operators, written as the driver's folders are."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# names that operators might use inside
CLASHING = ["ids", "fp", "key", "bucket", "word", "component_id", "rid", "score", "piece", "__spans"]


def rng(seed=5):
    return random.Random(seed)


def prose(r, words, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" + ("x" * r.randrange(5)) for _ in range(words))


def odd_texts():
    """Nulls, empty and blank texts, one very long text and one very long word, ties and repeats."""
    r = rng()
    long = prose(r, 30_000)
    same = prose(r, 120)
    near = same.split()
    near[60] = "changed"
    return [
        None,
        "",
        " \n\t ",
        "one",
        "two words",
        "x" * 20_000,
        "\x00null\x00bytes and ünïcödé 漢字 🙂 don't  stop\n\n\nnow  ",
        long,
        same,
        same,
        " ".join(near),
        "Nd, " * 700,
        *[prose(r, r.randrange(5, 200)) for _ in range(40)],
    ]


def odd_rows():
    texts = odd_texts()
    rows = [(i, t, [None, "en", "de"][i % 3], None if i % 7 == 0 else "s", i) for i, t in enumerate(texts)]
    return [*rows, rows[8], (None, texts[8], "en", "s", 1), (None, None, None, None, None)]


def documents(spark, rows, clash=False):
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("y").alias(c) for c in CLASHING])
    return df


def folder(spark, root, rows, clash=True):
    documents(spark, rows, clash).repartition(3).write.parquet(f"{root}/documents.parquet")
    return root
