"""Weekly extract files (CSV): scan and export.

Scan contract: header line skipped (columns bound by position, never by
header text), fixed schema, ``d/M/y`` dates, permissive rows (a bad field or
short row becomes null, the row stays), units truncated to int, sales read
straight into DECIMAL(13,2).

Export layout: one folder per week ending, ``<root>/week=<yyyy-MM-dd>/``,
of files with a header line, each sorted by retailer and SKU.  Rows go to their
week by a rebalance: Spark splits a large week by its bytes and puts small ones
together, and a file has at most ``FILE_ROWS`` rows.  An extract that is one delivery
is written as it is dealt to its tasks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .. import schemas
from ..functions.money import EXTRACT_DATE_FORMAT, to_money, to_units

# The date pattern of extract files and the partition column
# naming one weekly delivery folder.
EXTRACT_SCAN_DATE_FORMAT = "d/M/y"
DELIVERY_COLUMN = "week"

#: Rows of an exported file at most.
FILE_ROWS = 5_000_000


def read_extract(spark: SparkSession, path: str | list[str], with_file_path: bool = False) -> DataFrame:
    """Scan all CSV part files under ``path`` into the extract schema.

    ``with_file_path`` adds ``file_path``, the file each row came from.
    """
    raw = (
        spark.read.format("csv")
        .option("header", "true")
        .option("dateFormat", EXTRACT_SCAN_DATE_FORMAT)
        .option("mode", "PERMISSIVE")
        .schema(schemas.EXTRACT_CSV)
        .load(path)
    )
    return raw.select(
        "SKU",
        "Retailer",
        "Week Ending",
        to_units("Units").alias("Units"),
        to_money("Sales").alias("Sales"),
        *([F.col("_metadata.file_path").alias("file_path")] if with_file_path else []),
    )


def delivery_folders(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(FilePath) of every folder with extract files under ``path``, from the file listing: also files without rows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(path)
    return files.select(F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]*$", "").alias("FilePath")).distinct()


#: Bytes that a line of an extract file has about.
LINE_BYTES = 40


def about_rows(spark: SparkSession, path: str | list[str]) -> int:
    """Rows of the extract files under ``path``, about, from the bytes in the file listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(path)
    return int(files.agg(F.sum("length")).first()[0] or 0) // LINE_BYTES


def read_deliveries(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """Scan every weekly delivery folder under ``root`` (or the given ones of them) in one pass.

    Adds ``week`` (DATE), the delivery the row came in, from the folder
    name; used to decide which delivery wins for a key (latest).
    """
    schema = StructType([*schemas.EXTRACT_CSV.fields, StructField(DELIVERY_COLUMN, DateType())])
    raw = (
        spark.read.format("csv")
        .option("header", "true")
        .option("dateFormat", EXTRACT_SCAN_DATE_FORMAT)
        .option("mode", "PERMISSIVE")
        .option("basePath", root)
        .schema(schema)
        .load(folders or root)
    )
    return raw.select(
        "SKU",
        "Retailer",
        "Week Ending",
        to_units("Units").alias("Units"),
        to_money("Sales").alias("Sales"),
        F.col(DELIVERY_COLUMN),
        F.col("_metadata.file_path").alias("file_path"),
    )


def export_extract(df: DataFrame, root: str, delivery: str | _dt.date | None = None, file_rows: int = FILE_ROWS) -> None:
    """Write an extract as CSV folders, one per delivery week.

    ``delivery`` names a DATE column giving the delivery week of each row
    (default: its own ``Week Ending``).  Rows are computed once, rebalanced by
    week and sorted by (delivery, Retailer, SKU) in their task: every file is
    sorted, a task holds a share of a large week by bytes, and no file has more
    than ``file_rows`` rows.

    If ``delivery`` is a date, all rows are the delivery of that day: its folder alone is
    written, each task's rows to files of their own, and none are shuffled for it.
    """
    given = ["SKU", "Retailer", "Week Ending", "Units", "Sales"]
    if isinstance(delivery, _dt.date):
        files = df.select(*given).sortWithinPartitions("Retailer", "SKU").write
        root = f"{root}/{DELIVERY_COLUMN}={delivery.isoformat()}"
    else:
        week = F.col(delivery) if delivery else F.col("Week Ending")
        out = df.select(F.date_format(week, "yyyy-MM-dd").alias(DELIVERY_COLUMN), *given)
        files = out.hint("rebalance", DELIVERY_COLUMN).sortWithinPartitions(DELIVERY_COLUMN, "Retailer", "SKU").write.partitionBy(DELIVERY_COLUMN)
    files.mode("overwrite").option("header", "true").option("dateFormat", EXTRACT_DATE_FORMAT).option("maxRecordsPerFile", file_rows).csv(root)


def read_export_order(spark: SparkSession, root: str) -> DataFrame:
    """(folder, line, in_order): each data line of exported files, and whether its key is none before the line above it.

    Files are read in blocks like any text, of any size: lines are compared within
    their block, and the first of a block with the last of the block before.
    """
    fields = [f"`{f.name}` {'bigint' if f.name == 'SKU' else 'string'}" for f in schemas.EXTRACT_CSV.fields]
    row = F.from_csv("line", ", ".join(fields))
    lines = (
        spark.read.text(root + "/*/*.csv")
        .select(
            # below the root: every line carries it through the window
            F.substring_index(F.col("_metadata.file_path"), "/", -2).alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            F.col("value").alias("line"),
        )
        .where(~F.col("line").startswith("SKU,") & (F.col("line") != ""))
        .select("file", "block", "at", "line", F.struct(row["Retailer"], row["SKU"]).alias("key"))
    )
    within = Window.partitionBy("file", "block").orderBy("at")
    lines = lines.withColumn("above", F.lag("key").over(within))
    # a row a block: the key that the last line of the block before it has
    blocks = lines.groupBy("file", "block").agg(F.max_by("key", "at").alias("last"))
    blocks = blocks.select("file", "block", F.lag("last").over(Window.partitionBy("file").orderBy("block")).alias("before"))
    folder = F.regexp_extract("file", r"^(week=[^/]+)/", 1)
    above = F.coalesce("above", "before")
    return lines.join(blocks, ["file", "block"]).select(
        folder.alias("folder"), "line", (above.isNull() | (above <= F.col("key"))).alias("in_order")
    )


def read_extract_lines(spark: SparkSession, root: str) -> DataFrame:
    """Data lines of exported CSV files, with their delivery folder (headers dropped)."""
    text = spark.read.text(root + "/*/*.csv").select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/(week=[^/]+)/[^/]+$", 1).alias("folder"),
        F.col("value").alias("line"),
    )
    return text.where(~F.col("line").startswith("SKU,"))
