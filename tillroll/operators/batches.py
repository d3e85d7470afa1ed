"""Batch control: one id per delivered extract folder.

``register_batches`` registers every not-yet-known folder at once: the
distinct folders of the delivery files, anti-joined with the batch log, get
consecutive ids after the current maximum (1 for an empty log).  The id is
then stamped on the rows of that delivery (``...ByBatchId``).

The numbering window runs over the distinct NEW folders only - one row per
delivery, metadata-sized - never over data rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quality as Q

# Fixed value: table name in gate messages, and the gates in check order.
BATCH_TABLE = "Batch Control Table"
BATCH_GATE = [Q.unique("BatchId"), Q.not_null("BatchId"), Q.not_null("DataSource"), Q.not_null("FilePath")]


def delivery_folder(file_path):
    """Folder of a delivery file (its path minus the file name)."""
    col = F.col(file_path) if isinstance(file_path, str) else file_path
    return F.regexp_replace(col, r"/[^/]*$", "")


def register_batches(batch_log: DataFrame, folders: DataFrame, data_source: str) -> DataFrame:
    """New batch rows (BatchId, DataSource, FilePath) for folders not in the log."""
    fresh = folders.select("FilePath").distinct().join(batch_log.select("FilePath"), "FilePath", "left_anti")
    current = Q.max_or_zero(batch_log, "BatchId").first()["max_value"] or 0
    numbering = Window.orderBy("FilePath")
    return fresh.select(
        (F.lit(int(current)) + F.row_number().over(numbering)).cast("long").alias("BatchId"),
        F.lit(data_source).alias("DataSource"),
        F.col("FilePath"),
    )
