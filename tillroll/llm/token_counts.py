"""Token counts of flat token files: a separator scan stitched by a prefix scan.

A token file is nothing but ids, two bytes each, little-endian; an
end-of-document id follows each document, and no index says where.
``write_token_files`` makes such files with Spark's text writer, the separator
as its line end.  ``count_tokens`` reads files as binary rows cut into blocks of
``BLOCK`` ids, searches each block for the separator as one vector operation,
and stitches documents that run over block borders by a prefix scan per file:
the number of documents that end before a block, and the last end before it.

Any task holds one file at most (the writer bounds its files); a file's blocks
are scanned apart.  Null and empty texts are documents of no tokens.  Ids left
after a file's last separator are a document that isn't closed.  An empty table
gives no files and no rows.  A trailing odd byte is not an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .best_fit import encoder
from .common import table

#: The end-of-document id of the vocabulary, beyond its ranks.
END = 50256
BLOCK = 1 << 19
DOCS_PER_FILE = 20_000


def write_token_files(docs: DataFrame, path: str, text: str = "text", end: int = END) -> None:
    """Ids of every whole text of ``docs`` to flat files under ``path``, in the order of its partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder().encode_to_numpy
        for b in batches:
            ids = [encode(t.as_py() or "").astype("<u2").tobytes() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    ids = docs.select(F.col(f"`{text}`")).mapInArrow(run, "ids binary")
    separator = end.to_bytes(2, "little").decode("latin-1")
    writer = ids.select(F.col("ids").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
    writer.option("lineSep", separator).option("maxRecordsPerFile", DOCS_PER_FILE).text(path)


def scan_blocks(path_or_files: DataFrame, end: int = END, block: int = BLOCK) -> DataFrame:
    """(file, block, n, ends): ids in each block, and places in it of the separators."""
    size = 2 * block
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int")),
        lambda k: F.struct(k.alias("block"), F.substring(F.col("content"), k * size + 1, F.lit(size)).alias("data")),
    )
    blocks = path_or_files.where("length > 1").select(F.col("path").alias("file"), F.inline(cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                data = b.column(2)[i].as_py()
                ids = np.frombuffer(data, "<u2", len(data) // 2)
                at = np.flatnonzero(ids == end).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), b.column(1).slice(i, 1), pa.array([len(ids)], pa.int32()), pa.array([at], pa.list_(pa.int32()))],
                    names=["file", "block", "n", "ends"],
                )

    return blocks.mapInArrow(run, "file string, block int, n int, ends array<int>")


def count_tokens(spark: SparkSession, path: str, end: int = END, block: int = BLOCK) -> DataFrame:
    """file, doc_no (from 0), start, n_tokens and closed of every document of the files under ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "content")
    blocks = scan_blocks(files, end, block)
    first = F.col("block").cast("long") * block
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.element_at("ends", -1)
    placed = blocks.select(
        "file",
        first.alias("first"),
        "n",
        "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("doc_no"),
        (F.coalesce(F.max(F.when(F.size("ends") > 0, first + last)).over(before), F.lit(-1)) + 1).alias("open"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("at_end"),
    )
    closed = F.transform(
        "ends",
        lambda e, k: F.struct(
            (F.col("doc_no") + k).alias("doc_no"),
            F.when(k == 0, F.col("open")).otherwise(F.col("first") + F.get("ends", k - 1) + 1).alias("start"),
            (F.col("first") + e).alias("stop"),
            F.lit(True).alias("closed"),
        ),
    )
    rest_from = F.when(F.size("ends") > 0, F.col("first") + last + 1).otherwise(F.col("open"))
    rest = F.struct(
        (F.col("doc_no") + F.size("ends")).alias("doc_no"), rest_from.alias("start"), (F.col("first") + F.col("n")).alias("stop"), F.lit(False).alias("closed")
    )
    ragged = F.col("at_end") & (rest_from < F.col("first") + F.col("n"))
    every = F.when(ragged, F.concat(closed, F.array(rest))).otherwise(closed)
    return placed.select("file", F.inline(every)).select("file", "doc_no", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "closed")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, doc_no, start, n_tokens and closed of every document, from flat token files of ``documents``."""
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    part = F.concat_ws("-", F.regexp_extract("file", r"part-(\d+)", 1), F.regexp_extract("file", r"-(c\d+)[^/]*$", 1))
    return count_tokens(spark, path).withColumn("file", part)
