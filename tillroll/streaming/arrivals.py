"""Weekly deliveries as a stream: new extract files are loaded as they arrive.

A CSV file source over the delivery root (folders ``week=<yyyy-MM-dd>``) tells
which folders have new files; ``foreachBatch`` then loads those folders whole,
as ``plans.weekly_load.backfill`` does, so a delivery whose files arrive in
several micro-batches is judged as one delivery.  A delivery older than some that
are loaded already takes its place before them (``operators.fact``), and only its own
folder is read: the outcome is that of the deliveries' order, not of their arrival.

Exactly-once in effect: a micro-batch re-run after a failure loads the same
folders again, which changes and writes nothing.  The stream's checkpoint lives under the
shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from .. import schemas
from ..operators.batches import delivery_folder
from ..plans.weekly_load import LoadResult, backfill
from ..session import shared_root
from ..sources.extract import DELIVERY_COLUMN, EXTRACT_SCAN_DATE_FORMAT, delivery_folders
from ..sources.tables import Warehouse


def arrived_folders(spark: SparkSession, root: str) -> DataFrame:
    """Streaming (FilePath): the delivery folder of each row that arrives."""
    schema = StructType([*schemas.EXTRACT_CSV.fields, StructField(DELIVERY_COLUMN, DateType())])
    raw = (
        spark.readStream.format("csv")
        .option("header", "true")
        .option("dateFormat", EXTRACT_SCAN_DATE_FORMAT)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .load(root)
    )
    return raw.select(delivery_folder(F.col("_metadata.file_path")).alias("FilePath"))


def load_arrived(spark: SparkSession, wh: Warehouse, root: str, arrived: list[str], batch_ts=None) -> LoadResult | None:
    """Load the given folders and those of ``root`` that were never registered.  One row a delivery reaches the driver."""
    every = sorted(r.FilePath for r in delivery_folders(spark, root).collect())
    known = {r.FilePath for r in wh.read_batches(spark).select("FilePath").collect()}
    new = [f for f in every if f in arrived or f not in known]
    return backfill(spark, wh, root, batch_ts, folders=new) if new else None


def start_arrivals(
    spark: SparkSession,
    wh: Warehouse,
    root: str,
    name: str | None = "weekly_arrivals",
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start loading deliveries under ``root`` into ``wh``; returns the running query."""
    location = checkpoint or f"{shared_root(spark)}/tillroll/streams/{name or 'weekly_arrivals'}"

    def load(batch: DataFrame, epoch_id: int) -> None:
        arrived = [r.FilePath for r in batch.distinct().collect()]
        load_arrived(batch.sparkSession, wh, root, arrived)

    writer = arrived_folders(spark, root).writeStream.option("checkpointLocation", location).foreachBatch(load)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
