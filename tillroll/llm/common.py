"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# ASCII white space that ends a word, as a Java/Spark and a Python pattern.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark removes an execution's shuffle files at its end; nothing reads those of a table once it is written.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on executors that computed it, and the shuffle
    files behind it go at once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def crc_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, inside one expression."""
    return F.transform(F.array(value), body)[0]
