"""Publishing staged rows, so that a run cut short anywhere can be finished.

A load writes its rows to a staging folder of its own and gates them there.
``publish`` then notes the run as staged, applies it, and notes it as done.
Applying can be repeated: new members and batches are appended unless they are
there already, and fact weeks are replaced by their whole staged contents,
whatever a killed commit left of them.  ``recover`` applies runs that are staged
but not done, in the order of their loads; every load begins with it, holding the
warehouse's lease, so that no run of a load that is still at work is touched.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dimensions import held_keys
from ..operators.fact import fact_table_rows, touched_date_ids
from ..session import sized_reads
from ..sources.tables import Warehouse, read_or_empty, write_table


def _note(spark: SparkSession, wh: Warehouse, run: str, state: str) -> None:
    write_table(spark.createDataFrame([(run, state)], schemas.RUNS).coalesce(1), wh.runs, "append")


def _append_missing(rows: DataFrame, present: DataFrame, path: str, keys: list[str]) -> None:
    held = held_keys(rows, present, keys[-1])
    if len(keys) > 1:
        held = present.select(*keys).join(held, keys[-1], "left_semi")
    missing = rows.join(held, keys, "left_anti").select(*rows.columns)
    if not missing.isEmpty():
        write_table(missing, path, "append")


def _apply(spark: SparkSession, wh: Warehouse, run: str, held: Callable[[], None]) -> None:
    """``held`` raises an error if another load has taken the warehouse over; it is asked before each write."""
    stage = wh.stage(run)
    read = lambda name, schema: read_or_empty(spark, f"{stage}/{name}", schema)
    held()
    merged = spark.read.parquet(f"{stage}/merged")
    tables = [
        (read("key_exceptions", schemas.KEY_EXCEPTIONS), wh.read_key_exceptions(spark), wh.key_exceptions, ["Kind", "Name"]),
        (read("product", schemas.PRODUCT), wh.read_product(spark), wh.product, ["ProductName"]),
        (read("retailer", schemas.RETAILER), wh.read_retailer(spark), wh.retailer, ["RetailerName"]),
        (read("batch", schemas.BATCH), wh.read_batches(spark), wh.batch, ["FilePath"]),
    ]
    # four small appends that don't depend on each other, at the same time; the fact only after all of them
    with ThreadPoolExecutor(len(tables) + 1) as pool:
        # whole weeks, but only those in which a row differs; a big week has several files
        changed = pool.submit(touched_date_ids, merged.where(F.col("_action").isin("insert", "update") | F.col("_noted")))
        for done in [pool.submit(_append_missing, *t) for t in tables]:
            done.result()
        weeks = changed.result()
    held()
    if weeks:
        # the merge has dealt the rows by week: each file of it, read by itself, holds a few
        rows = fact_table_rows(merged.where(F.col("DateId").isin(weeks)))
        with sized_reads(spark):
            write_table(rows, wh.sales, "partitions", "DateId")


def publish(spark: SparkSession, wh: Warehouse, run: str, held: Callable[[], None]) -> None:
    """Make the staged run part of the warehouse."""
    held()
    _note(spark, wh, run, "staged")
    _apply(spark, wh, run, held)
    _note(spark, wh, run, "done")


def recover(spark: SparkSession, wh: Warehouse, held: Callable[[], None] = lambda: None) -> list[str]:
    """Finish runs that were staged but not done, earlier loads first; returns them."""
    runs = read_or_empty(spark, wh.runs, schemas.RUNS).groupBy("Run").agg(F.collect_set("State").alias("s"))
    open_ = [r.Run for r in runs.where(F.array_contains("s", "staged") & ~F.array_contains("s", "done")).collect()]
    open_.sort(key=lambda run: ("-" in run, run))  # a run's name begins with its load's number; before there were numbers it had none
    for run in open_:
        _apply(spark, wh, run, held)
        _note(spark, wh, run, "done")
    return open_
