"""Sales fact: conform, enrich, resolve keys, and the upsert merge.

Key = (DateId, ProductId, RetailerId).  SKU and DataSource are values, so two
SKUs of one product from one retailer in one week collide on the key and stop
the load at the uniqueness gate.

The merge (``merge_fact``) takes the fact rows of the touched ``DateId``
partitions and the incoming rows.  The incoming rows are reduced to one row per
key, counting repeats; a full outer join with the stored rows, unique by
contract, then classifies every key:

* ``insert``    - key only in the batch: new row, created now;
* ``update``    - key in both, some value differs (null-safe): batch values,
                  original creation time, updated now;
* ``unchanged`` - key in both, all values equal: the stored row as it is
                  (replaying a batch changes nothing);
* ``keep``      - key only in the table: the stored row.

Deliveries have an order of their own, their date, and each stored row keeps the
deliveries that gave it values (``Deliveries``: a step with date, batch and values
for each).  A dated load puts its steps among them, in place of an earlier one of the
same date, and the row becomes what the deliveries give in their order: created by
the first, last updated by the last that changed a value.  So the outcome depends on
the deliveries alone: one that is loaded again changes nothing, a late older one takes
its place without the later ones being read again, and the newest delivery of a key
holds whatever arrives after it.  A load without dates applies its rows on arrival; a
row that it changes has no history from then on, and the next dated load starts
from the row as it is.

The reduction also counts rows that repeat a key within a delivery (``_extra``), so
the uniqueness gate needs no shuffle.

A load deals both sides out once, by week and share of a week (``dealt``): that serves
the reduction, the join and the write by week.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import WIDE_BITS, member_key
from ..functions.money import to_money
from ..schemas import AUDIT, DATA_SOURCE_MAT, FACT_KEY, FACT_VALUES, HISTORY, STEP
from . import quality as Q
from .dimensions import batch_time, held_keys

# Fixed value: table name in gate messages, and the fact gates in check order.
SALES_TABLE = "Sales Fact Table"
SALES_GATE = [
    Q.not_null("DateId", weight="_rows"),
    Q.not_null("ProductId", weight="_rows"),
    Q.not_null("RetailerId", weight="_rows"),
    Q.unique_by_count(FACT_KEY, "_extra"),
]


def conform_extract(extract: DataFrame, carry: list[str] | None = None, data_source: str = DATA_SOURCE_MAT) -> DataFrame:
    """Extract rows renamed to fact vocabulary, with the source tag."""
    return extract.select(
        F.col("Week Ending").alias("Date"),
        F.col("SKU"),
        F.col("Retailer"),
        F.col("Units").alias("UnitsSold"),
        to_money("Sales").alias("SalesAmount"),
        F.lit(data_source).alias("DataSource"),
        *[F.col(c) for c in (carry or [])],
    )


def used_mapper(rows: DataFrame, mapper: DataFrame) -> DataFrame:
    """The mapper rows of the (SKU, Retailer) pairs that the few ``rows`` have, which are broadcast: none of the mapper is shuffled."""
    return mapper.join(F.broadcast(rows.select("SKU", "Retailer").distinct()), ["SKU", "Retailer"], "left_semi")


def enrich_extract(rows: DataFrame, mapper: DataFrame, repeats: str | None = None, few: bool = False) -> DataFrame:
    """Left join to the SKU mapper on (SKU, Retailer): adds Description, ProductType.

    An unmapped SKU keeps its row with null names (stopped later by gates).  The rows
    are read once and meet the mapper in the join; of ``few`` rows (some ``SENT_KEYS``
    at most) the pairs are read ahead to cut the mapper to them.  The join strategy is
    the planner's.  ``repeats`` names a column for the mapper rows beside the first that the row's pair
    has; any > 0 would double count.  They are counted on the way to the join, in its order.
    """
    used = used_mapper(rows, mapper) if few else mapper.where(F.col("SKU").isNotNull() & F.col("Retailer").isNotNull())
    used = used.select("SKU", "Retailer", "Description", "ProductType")
    if repeats:
        used = used.withColumn(repeats, F.count(F.lit(1)).over(Window.partitionBy("SKU", "Retailer")) - 1)
    return rows.join(used, ["SKU", "Retailer"], "left").select(*rows.columns, "Description", "ProductType", *([repeats] if repeats else []))


def combined(enriched: DataFrame, weight: str) -> DataFrame:
    """Enriched rows that differ in their figures only as one row, with their number (``weight``) and any of their figures.

    Rows that met the mapper in a shuffle by (SKU, Retailer) are combined where they are.
    """
    figures = ["UnitsSold", "SalesAmount"]
    return enriched.groupBy(*[c for c in enriched.columns if c not in figures]).agg(F.count(F.lit(1)).alias(weight), *[F.min(c).alias(c) for c in figures])


def _with_exceptions(rows: DataFrame, exceptions: DataFrame | None, kind: str, name: str, id_col: str) -> DataFrame:
    if exceptions is None:
        return rows
    few = exceptions.where(F.col("Kind") == kind).select(F.col("Name").alias(f"_{id_col}_name"), F.col("Id").alias(f"_{id_col}"))
    return rows.join(few, F.col(name) == F.col(f"_{id_col}_name"), "left").drop(f"_{id_col}_name")


def resolve_keys(
    enriched: DataFrame, dates: DataFrame, bits: int = WIDE_BITS, carry: list[str] | None = None, exceptions: DataFrame | None = None
) -> DataFrame:
    """Fact rows with surrogate keys.

    ``ProductId``/``RetailerId`` are the keys of the names, or the id that the key
    ``exceptions`` (Kind, Name, Id) hold (null name -> null id).  ``DateId`` comes
    from the calendar, so a date outside it gets a null id; the calendar, a row a
    day of the years it was built for, is broadcast.
    """
    out = enriched.join(F.broadcast(dates.select("Date", "DateId")), "Date", "left")
    out = _with_exceptions(out, exceptions, "product", "Description", "ProductId")
    out = _with_exceptions(out, exceptions, "retailer", "Retailer", "RetailerId")

    def key(name: str, id_col: str) -> Column:
        plain = member_key(name, bits)
        return (plain if exceptions is None else F.coalesce(f"_{id_col}", plain)).alias(id_col)

    return out.select(
        F.col("DateId"),
        key("Description", "ProductId"),
        key("Retailer", "RetailerId"),
        *[F.col(c) for c in FACT_VALUES],
        *[F.col(c) for c in (carry or [])],
    )


def orphans(resolved: DataFrame, dim_ids: DataFrame, id_col: str) -> DataFrame:
    """Ids of the batch that the dimension (its ids and the new ones) does not hold."""
    ids = resolved.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return ids.join(held_keys(ids, dim_ids, id_col), id_col, "left_anti")


def _values_differ(a, b) -> Column:
    """Null-safe: does any fact value differ?  ``a``, ``b``: column getters by name."""
    return ~F.struct(*[a(c).alias(c) for c in FACT_VALUES]).eqNullSafe(F.struct(*[b(c).alias(c) for c in FACT_VALUES]))


def dealt(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """``rows`` shuffled by week and share of it (``_share``), of which ``shares`` (DateId, _shares) gives each week a number.

    A share has whole keys.  Those of a week are about equal, so that no task gets a large week.
    """
    share = F.pmod(F.xxhash64("ProductId", "RetailerId"), F.coalesce("_shares", F.lit(1))).cast("int")
    return rows.join(F.broadcast(shares), "DateId", "left").withColumn("_share", share).drop("_shares").repartition("DateId", "_share")


def _reduced(
    incoming: DataFrame, bid: Column, delivery: str | None, day: _dt.date | None, data_source: str | None, key: list[str], weight: str | None
) -> DataFrame:
    """One row per key: rows, repeats within a delivery, and the values (``_next``), for dated loads the deliveries (``_steps``) too.

    Rows of one key and delivery are combined before the shuffle, however many they are,
    unless the rows were dealt before.
    """
    rows = incoming.withColumn("_bid", bid.cast("int"))
    if delivery:
        rows = rows.withColumn("_ord", F.coalesce(F.col(delivery).cast("date"), F.lit("0001-01-01").cast("date")))
    # any row's values do: with more than one row the gate stops the load
    plain = [c for c in FACT_VALUES if not (c == "DataSource" and data_source)]
    out = rows.groupBy(*key, *(["_ord"] if delivery else [])).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"), F.min("_bid").alias("_bid"), *[F.min(c).alias(f"_next_{c}") for c in plain]
    )
    if len(plain) < len(FACT_VALUES):
        out = out.withColumn("_next_DataSource", F.lit(data_source))
    out = out.withColumn("_repeats", F.col("_n") - 1)
    step = F.struct(F.col("_ord") if delivery else F.lit(day).cast("date").alias("ord"), "_bid", *[f"_next_{c}" for c in FACT_VALUES]).cast(STEP)
    if delivery:  # bounded by the deliveries of the run
        return out.groupBy(*key).agg(F.sum("_n").alias("_n"), F.sum("_repeats").alias("_repeats"), F.collect_list(step).alias("_steps"))
    return out.withColumn("_steps", F.array(step)) if day else out


def merge_fact(
    existing: DataFrame,
    incoming: DataFrame,
    batch_ts: _dt.datetime | str | None = None,
    batch_id: int | None = None,
    delivery: str | None = None,
    batch_id_col: str | None = None,
    data_source: str | None = None,
    day: _dt.date | None = None,
    weight: str | None = None,
    shares: DataFrame | None = None,
) -> DataFrame:
    """Classified fact rows of the touched partitions (see module doc), one row per key.

    Output: fact columns + ``Deliveries`` + ``_action`` + ``_noted`` (the row's
    deliveries differ from the stored ones, its values may not) + ``_rows`` (input
    rows the output row stands for) + ``_extra`` (rows that repeat the key within their
    delivery; any > 0 fails the uniqueness gate, so a repeated key is never written).
    ``existing`` may come without ``Deliveries``: then no row has a history.
    ``existing`` must hold only the partitions the batch touches (the caller
    prunes by DateId).  ``delivery`` (optional DATE column of ``incoming``)
    orders deliveries, ``day`` is the date of all rows if they are one delivery; ``batch_id_col`` (optional) gives a per-row batch id;
    ``data_source`` is the tag of all incoming rows, if they have one; ``weight`` names a
    column with the number of rows that each stands for (see ``combined``).

    Plan: the incoming rows are combined per key on the map side and shuffled
    once; that order serves the join, whose sides are both unique by key.  With
    ``shares`` (DateId, _shares) both sides are ``dealt`` instead, which serves the write
    by week too and a run of several deliveries; repeats should be ``combined`` before.
    """
    now = batch_time(batch_ts)
    bid = F.col(batch_id_col) if batch_id_col else F.lit(batch_id)
    key = FACT_KEY
    if shares is not None:
        existing, incoming, key = dealt(existing, shares), dealt(incoming, shares), ["DateId", "_share", "ProductId", "RetailerId"]
    new = _reduced(incoming, bid, delivery, day, data_source, key, weight)
    dated = bool(delivery or day)
    history = F.col(HISTORY) if HISTORY in existing.columns else F.lit(None)
    old = existing.select(
        *key, *[F.col(c).alias(f"_prev_{c}") for c in (*FACT_VALUES, *AUDIT)], history.cast(f"array<{STEP.simpleString()}>").alias("_history"), F.lit(True).alias("_has_prev")
    )
    both = old.join(new, key, "full_outer")
    has_prev, has_new = F.col("_has_prev").isNotNull(), F.col("_n").isNotNull()
    prev = lambda c: F.col(f"_prev_{c}")
    fields = [(c, existing.schema[c].dataType) for c in FACT_VALUES]
    none = F.array().cast(f"array<{STEP.simpleString()}>")

    def state(has, value, created, updated) -> Column:
        return F.struct(has.alias("has"), *[value(c).cast(t).alias(c) for c, t in fields], created.cast("int").alias("created"), updated.cast("int").alias("updated"))

    stored = state(has_prev, prev, prev("CreatedByBatchId"), prev("UpdatedByBatchId"))

    def apply(s, value, b) -> Column:
        first = state(F.lit(True), value, b, F.lit(None))
        changed = state(F.lit(True), value, s["created"], b)
        return F.when(~s["has"], first).when(_values_differ(lambda c: s[c], value), changed).otherwise(s)

    if dated:
        # the row's deliveries in order, those of this load in place of earlier ones of their dates
        given = F.coalesce("_steps", none)
        others = F.filter(F.coalesce("_history", none), lambda h: ~F.exists(given, lambda g: g["ord"] == h["ord"]))
        both = both.withColumn("_all", F.array_sort(F.concat(others, given)))
        nothing = state(F.lit(False), lambda c: F.lit(None), F.lit(None), F.lit(None))
        start = F.when(has_prev & F.col("_history").isNull(), stored).otherwise(nothing)
        end = F.aggregate("_all", start, lambda s, d: apply(s, lambda c: d[c], d["bid"]))
        # a row from before there were histories starts one only where nothing of it is lost
        kept = F.when(~has_prev | F.col("_history").isNotNull(), F.col("_all"))
        end, kept = F.when(has_new, end).otherwise(stored), F.when(has_new, kept).otherwise(F.col("_history"))
    else:
        nxt = lambda c: F.col(f"_next_{c}")
        end = F.when(has_new, apply(stored, nxt, F.col("_bid"))).otherwise(stored)
        kept = F.when(has_prev & (~has_new | ~_values_differ(prev, nxt)), F.col("_history"))
    both = both.withColumn("_end", end).withColumn("_kept", kept)
    updated = ~F.col("_end.updated").eqNullSafe(prev("UpdatedByBatchId")) | _values_differ(prev, lambda c: F.col(f"_end.{c}"))
    changed = has_prev & (updated | ~F.col("_end.created").eqNullSafe(prev("CreatedByBatchId")))
    action = (
        F.when(~has_new, F.lit("keep")).when(~has_prev, F.lit("insert")).when(changed, F.lit("update")).otherwise(F.lit("unchanged"))
    )
    # a new row that a later delivery of the same load changed was updated too
    stamped = F.when(has_prev, updated).otherwise(F.col("_end.updated").isNotNull() | F.col("_twice")) if dated else has_prev & updated
    if dated:
        both = both.withColumn("_twice", F.size("_all") > 1).withColumn("_twice", F.col("_twice") & F.exists("_all", lambda d: _values_differ(lambda c: d[c], lambda c: F.col("_all")[0][c])))
    return both.select(
        *FACT_KEY,
        *[F.col(f"_end.{c}").alias(c) for c in FACT_VALUES],
        F.when(has_prev, prev("CreatedTime")).otherwise(now).alias("CreatedTime"),
        F.col("_end.created").alias("CreatedByBatchId"),
        F.when(stamped, now).otherwise(prev("UpdatedTime")).alias("UpdatedTime"),
        F.col("_end.updated").alias("UpdatedByBatchId"),
        F.col("_kept").alias(HISTORY),
        action.alias("_action"),
        (~F.col("_kept").eqNullSafe(F.col("_history"))).alias("_noted"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("_rows"),
        F.coalesce("_repeats", F.lit(0)).cast("long").alias("_extra"),
    )


def fact_table_rows(merged: DataFrame) -> DataFrame:
    """The stored columns of classified rows."""
    return merged.select(*FACT_KEY, *FACT_VALUES, *AUDIT, HISTORY)


def touched_date_ids(resolved: DataFrame) -> list[int]:
    """Distinct DateIds of a batch (a handful of weeks; bounded by the calendar)."""
    return sorted(r[0] for r in resolved.select("DateId").where(F.col("DateId").isNotNull()).distinct().collect())


def date_rows(rows: DataFrame, weight: str | None = None) -> dict[int, int]:
    """Rows of each DateId (bounded by the calendar); ``weight`` as in the merge.  Rows without a DateId are left out."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return {r.DateId: r.n for r in rows.where(F.col("DateId").isNotNull()).groupBy("DateId").agg(n.alias("n")).collect()}


def changed_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keys present in both with some value different (null-safe), old and new values side by side.

    As in the merge, ``existing`` should hold the touched partitions only.
    """
    o = existing.select(*FACT_KEY, *[F.col(c).alias(f"Old{c}") for c in FACT_VALUES])
    n = incoming.select(*FACT_KEY, *[F.col(c).alias(f"New{c}") for c in FACT_VALUES])
    return o.join(n, FACT_KEY, "inner").where(_values_differ(lambda c: F.col(f"Old{c}"), lambda c: F.col(f"New{c}")))
