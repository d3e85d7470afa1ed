"""Conformed dimensions (product, retailer): insert-only, hash surrogate ids.

A member, once present, is never updated - not even its product type.  New
members are the batch's distinct names that the dimension does not hold
(anti join); their id is the key of the name, and ``settle_ids`` gives another
to the few whose id is taken.  New rows are gated among themselves and against
the stored rows with an equal id (``gate_scope``): stored rows passed before, so
the cost follows the batch.  Only new rows are appended.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import WIDE_BITS, key_of
from . import quality as Q

# Table names in gate messages and the gates of each table,
# in the order they are checked.
PRODUCT_TABLE = "Product Dimension Table"
RETAILER_TABLE = "Retailer Dimension Table"
PRODUCT_GATE = [
    Q.unique("ProductId"),
    Q.unique("ProductName"),
    Q.not_null("ProductId"),
    Q.not_null("ProductName"),
    Q.not_null("ProductType"),
]
RETAILER_GATE = [
    Q.unique("RetailerId"),
    Q.unique("RetailerName"),
    Q.not_null("RetailerId"),
    Q.not_null("RetailerName"),
]


def batch_time(batch_ts: _dt.datetime | str | None) -> Column:
    """Load time stamped on rows: the run's ``batch_ts``, or now.

    Text without an offset and a naive datetime are wall-clock times of the
    session's zone; an aware datetime or text with an offset is that instant.
    """
    if batch_ts is None:
        return F.current_timestamp()
    if isinstance(batch_ts, _dt.datetime) and batch_ts.tzinfo is not None:
        batch_ts = batch_ts.isoformat(" ")
    return F.lit(str(batch_ts)).cast("timestamp")


def _first_delivery_only(candidates: DataFrame, name: str, delivery: str | None) -> DataFrame:
    """With several deliveries in one run, a member counts from its first delivery only.

    This is what week-by-week loading does: a later delivery never changes
    a member already inserted.  ``candidates`` is already distinct per
    (name, attributes, delivery), so each window group is bounded by the
    number of deliveries.
    """
    if delivery is None:
        return candidates
    first = F.min(delivery).over(Window.partitionBy(name))
    return candidates.withColumn("_first", first).where(F.col(delivery) == F.col("_first")).drop("_first", delivery)


def product_candidates(enriched: DataFrame, delivery: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """Distinct (ProductName, ProductType) of an enriched batch (plus ``carry`` columns)."""
    cols = [F.col("Description").alias("ProductName"), F.col("ProductType"), *[F.col(c) for c in carry or []]]
    if delivery:
        cols.append(F.col(delivery))
    return _first_delivery_only(enriched.select(*cols).distinct(), "ProductName", delivery).distinct()


def retailer_candidates(
    extract: DataFrame, delivery: str | None = None, carry: list[str] | None = None, column: str = "Retailer"
) -> DataFrame:
    """Distinct RetailerName of a batch (plus ``carry`` columns)."""
    cols = [F.col(column).alias("RetailerName"), *[F.col(c) for c in carry or []]]
    if delivery:
        cols.append(F.col(delivery))
    return _first_delivery_only(extract.select(*cols).distinct(), "RetailerName", delivery).distinct()


#: Keys of a batch that are broadcast to look them up in a stored table; more of them meet it in a shuffle.
SENT_KEYS = 1_000_000


def held_keys(keys: DataFrame, table: DataFrame, key: str, limit: int = SENT_KEYS) -> DataFrame:
    """(key): the distinct ``keys`` that ``table`` holds, with the cost of a scan of one column of the table.

    The batch goes to the table, not the table to the batch: up to ``limit`` keys
    (counted, not estimated) are broadcast and the table is filtered where it is read;
    with more, both meet in a shuffle.  What comes back is no larger than the batch.
    Null keys are never held.
    """
    few = keys.select(key).where(F.col(key).isNotNull()).distinct()
    few = F.broadcast(few) if few.limit(limit + 1).count() <= limit else few
    return table.select(key).join(few, key, "left_semi").distinct()


def new_members(
    candidates: DataFrame,
    dim: DataFrame,
    name: str,
    id_col: str,
    batch_ts: _dt.datetime | None = None,
    batch_id: int | None = None,
    bits: int = WIDE_BITS,
    batch_id_col: str | None = None,
) -> DataFrame:
    """Candidates not yet in ``dim`` (by name), with ids and audit columns.

    A null name never matches, so it comes out as a new member and is
    stopped by the not-null gate.  ``batch_id_col`` (a candidate column)
    gives each member the batch it first arrived in.  The dimension is filtered
    to the candidates' names first (``held_keys``), never shuffled for them.
    """
    fresh = candidates.join(held_keys(candidates, dim, name), name, "left_anti")
    attrs = [c for c in candidates.columns if c not in (name, batch_id_col)]
    bid = F.col(batch_id_col) if batch_id_col else F.lit(batch_id)
    return fresh.select(
        key_of(name, bits).alias(id_col),
        F.col(name),
        *[F.col(c) for c in attrs],
        batch_time(batch_ts).alias("CreatedTime"),
        bid.cast("int").alias("CreatedByBatchId"),
        F.lit(None).cast("timestamp").alias("UpdatedTime"),
        F.lit(None).cast("int").alias("UpdatedByBatchId"),
    )


def taken_ids(fresh: DataFrame, dim: DataFrame, name: str, id_col: str) -> DataFrame:
    """(id, first): ids that a new member shares with another one, and the name that keeps it (null: a stored one)."""
    stored_ids = held_keys(fresh, dim, id_col).select(id_col, F.lit(None).cast("string").alias(name), F.lit(1).alias("old"))
    both = fresh.select(id_col, name, F.lit(0).alias("old")).unionByName(stored_ids)
    found = both.groupBy(id_col).agg(F.count_distinct(F.coalesce(name, F.lit("\0"))).alias("n"), F.max("old").alias("old"), F.min(name).alias("least"))
    return found.where("n > 1").select(id_col, F.when(F.col("old") == 0, F.col("least")).alias("first"))


def settle_ids(
    fresh: DataFrame, dim: DataFrame, name: str, id_col: str, bits: int, keep: Callable[[DataFrame, str], DataFrame], tries: int = 64
) -> tuple[DataFrame, DataFrame | None]:
    """``fresh`` with unique ids, and (name, id) of those that were changed (None if no id collides at ``bits`` bits).

    A member whose id another one holds gets a salted id, until none collides;
    the smallest of new names keeps the plain id, a stored member always does.
    Each round is a join: ``keep`` (given a frame and a label) stores its names and
    ids where executors can read them, so nothing comes to the driver and no plan
    repeats an earlier round.
    """
    given = fresh.columns
    fresh = fresh.withColumn("_moved", F.lit(False))
    for salt in range(1, tries + 1):
        taken = taken_ids(fresh, dim, name, id_col)
        losers = fresh.where(F.col(name).isNotNull()).join(taken, id_col).where(~F.col(name).eqNullSafe(F.col("first")))
        moved = losers.select(F.col(name).alias("_name"), key_of(name, bits, salt).alias("_id")).distinct()
        if moved.isEmpty():
            changed = fresh.where("_moved").select(name, id_col).distinct() if salt > 1 else None
            return fresh.select(*given), changed
        moved = keep(moved, f"moved_{id_col}_{salt}")
        fresh = fresh.join(moved, F.col(name) == F.col("_name"), "left").select(
            *[F.coalesce("_id", id_col).alias(c) if c == id_col else F.col(c) for c in given],
            (F.col("_moved") | F.col("_id").isNotNull()).alias("_moved"),
        )
    raise Q.GateError(f"ETL: {id_col} - no free id of {bits} bits found; the warehouse needs wider ids")


def gate_scope(fresh: DataFrame, dim: DataFrame, id_col: str) -> DataFrame:
    """New rows and the stored rows that share an id with one: what the gate has to look at."""
    return fresh.unionByName(dim.join(fresh.select(id_col), id_col, "left_semi").select(*fresh.columns))


def merge_dim(dim: DataFrame, fresh: DataFrame) -> DataFrame:
    """The next dimension: existing members plus new ones (duplicates kept, for the gate)."""
    return dim.unionByName(fresh.select(*dim.columns))
