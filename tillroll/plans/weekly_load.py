"""Weekly load: product -> retailer -> sales fact for one extract, and backfill.

Order of work for one batch:

1. a publishing run that was cut short is finished (``plans.publish``);
2. the batch's folders are registered, from the file listing;
3. new members, with settled ids, and the merged fact rows of the touched weeks
   are written once to the warehouse's staging folder;
4. all gates are evaluated on what was staged, in one job; the first failure in
   the order below is raised, and no table has changed:
   lookup (the SKU mapper must be unique for the pairs the batch uses), batch
   log, product, retailer, sales fact, ids the dimensions don't hold;
5. the staged rows are published: exactly the rows that passed.

Weeks in which no row and no row's list of deliveries differs are not written: a load
that is repeated writes no fact file.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.keys import WIDE_BITS
from ..operators import quality as Q
from ..operators.batches import BATCH_GATE, BATCH_TABLE, delivery_folder, register_batches
from ..operators.dimensions import (
    PRODUCT_GATE,
    PRODUCT_TABLE,
    RETAILER_GATE,
    RETAILER_TABLE,
    SENT_KEYS,
    gate_scope,
    merge_dim,
    new_members,
    product_candidates,
    retailer_candidates,
    settle_ids,
)
from ..operators.fact import (
    SALES_GATE,
    SALES_TABLE,
    combined,
    conform_extract,
    date_rows,
    enrich_extract,
    merge_fact,
    orphans,
    resolve_keys,
    touched_date_ids,
)
from ..schemas import DATA_SOURCE_MAT
from ..session import ALL_KEYS, TASK_ROWS, settings, sized_shuffles
from ..sources.extract import DELIVERY_COLUMN, about_rows, delivery_folders, read_deliveries, read_extract
from ..sources.lease import Lease, writer_lease
from ..sources.tables import Warehouse, write_table
from .publish import publish, recover

# Fixed value: table name of the lookup in gate messages.
MAPPER_TABLE = "SKU Mapper Table"
MAPPER_GATE = [Q.unique_by_count(["SKU", "Retailer"], "_mapper_extra")]


@dataclass
class LoadResult:
    touched_date_ids: list[int]
    written_date_ids: list[int]
    new_products: int
    new_retailers: int
    new_batches: int


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).isoformat(" ", "seconds")


def load_batch(
    spark: SparkSession,
    wh: Warehouse,
    extract: DataFrame,
    batch_ts: _dt.datetime | str | None = None,
    batch_id: int | None = None,
    delivery: str | None = None,
    folder: str | None = None,
    folders: DataFrame | None = None,
    data_source: str = DATA_SOURCE_MAT,
    bits: int | None = None,
    day: _dt.date | None = None,
    size: int | None = None,
) -> LoadResult:
    """Load one scanned extract into the warehouse ``wh``.

    ``delivery``: DATE column ordering several deliveries in one run; ``day``: the
    date of the one delivery that all rows are (neither: rows apply on arrival).
    ``folder``: column naming the delivery folder of each row; ``folders``
    (FilePath), by default those that have rows, are registered in the batch log
    and their ids stamped on the rows (otherwise ``batch_id``, possibly None, is
    stamped).  ``bits``: id width of a new warehouse; another one than a
    warehouse has is refused.  ``size``: the extract's rows, about, if known; its
    shuffles get tasks by them, by the mapper's and by the touched stored rows.  A warehouse that another load holds is refused with
    ``WarehouseBusy`` (see ``sources.lease``).
    """
    ts = batch_ts if batch_ts is not None else _now()
    with writer_lease(spark, wh) as lease:
        recover(spark, wh, lease.renew)
        with sized_shuffles(spark, max(size or 0, wh.read_sku_mapper(spark).count())):
            return _load(spark, wh, extract, ts, batch_id, delivery, folder, folders, data_source, bits, day, size, lease)


def _load(
    spark: SparkSession,
    wh: Warehouse,
    extract: DataFrame,
    ts: _dt.datetime | str,
    batch_id: int | None,
    delivery: str | None,
    folder: str | None,
    folders: DataFrame | None,
    data_source: str,
    bits: int | None,
    day: _dt.date | None,
    size: int | None,
    lease: Lease,
) -> LoadResult:
    width = wh.key_bits(spark, bits, WIDE_BITS)
    run = f"{lease.number:012d}-{uuid.uuid4().hex[:12]}"
    stage = wh.stage(run)
    enriched: DataFrame | None = None

    def staged(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{stage}/{name}", "overwrite")
        return spark.read.schema(df.schema).parquet(f"{stage}/{name}")

    try:
        mapper = wh.read_sku_mapper(spark)
        conformed = conform_extract(extract, [c for c in (delivery, folder) if c], data_source)
        # what the extract files and the mapper give: as large as the delivery, so staged, and without the shuffle that made it
        enriched = enrich_extract(conformed, mapper, "_mapper_extra", size is not None and size <= SENT_KEYS)
        enriched = staged(combined(enriched, "_n"), "enriched")
        repeats = enriched.select((F.col("_mapper_extra") * F.col("_n")).alias("_mapper_extra"))
        reports = [("mapper", Q.gate_report(repeats, MAPPER_TABLE, MAPPER_GATE))]
        rows = enriched

        bid_col, n_batches = None, 0
        if folder:
            given = folders if folders is not None else enriched.select(F.col(folder).alias("FilePath")).distinct()
            log = wh.read_batches(spark)
            new_batches = staged(register_batches(log, given, data_source), "batch")
            reports.append(("batch", Q.gate_report(merge_dim(log, new_batches), BATCH_TABLE, BATCH_GATE)))
            known = log.join(given, "FilePath", "left_semi").unionByName(new_batches)
            # a row for each delivery of this run, as literals: no table that is published below is in the plan
            ids = [(r.FilePath, int(r.BatchId)) for r in known.select("FilePath", "BatchId").collect()]
            n_batches = new_batches.count()
            frame = spark.createDataFrame(ids, f"`{folder}` string, _batch_id int")
            rows = enriched.join(F.broadcast(frame), folder, "left")
            bid_col = "_batch_id"
        bid_carry = [bid_col] if bid_col else []

        prod_old, ret_old = wh.read_product(spark), wh.read_retailer(spark)

        def members(candidates: DataFrame, old: DataFrame, label: str, name: str, id_col: str) -> tuple[DataFrame, DataFrame | None]:
            # three steps of the look-up read the names; the delivery's rows are read for them once
            candidates = staged(candidates, f"{label}_candidates")
            found = staged(new_members(candidates, old, name, id_col, ts, batch_id, width, bid_col), f"{label}_found")
            settled, moved = settle_ids(found, old, name, id_col, width, staged)
            return staged(settled, label), moved

        dims = [
            (product_candidates(rows, delivery, bid_carry), prod_old, "product", "ProductName", "ProductId"),
            (retailer_candidates(rows, delivery, bid_carry), ret_old, "retailer", "RetailerName", "RetailerId"),
        ]
        with ThreadPoolExecutor(len(dims)) as pool:  # the two don't depend on each other, and their jobs are small
            (prod_new, prod_moved), (ret_new, ret_moved) = pool.map(lambda d: members(*d), dims)
        new_exceptions = spark.createDataFrame([], schemas.KEY_EXCEPTIONS)
        for kind, moved in (("product", prod_moved), ("retailer", ret_moved)):
            if moved is not None:
                new_exceptions = new_exceptions.union(moved.select(F.lit(kind), *moved.columns))
        new_exceptions = staged(new_exceptions, "key_exceptions")
        exceptions = wh.read_key_exceptions(spark).unionByName(new_exceptions)
        reports.append(("product", Q.gate_report(gate_scope(prod_new, prod_old, "ProductId"), PRODUCT_TABLE, PRODUCT_GATE)))
        reports.append(("new_products", Q.row_count(prod_new, "product")))
        reports.append(("retailer", Q.gate_report(gate_scope(ret_new, ret_old, "RetailerId"), RETAILER_TABLE, RETAILER_GATE)))
        reports.append(("new_retailers", Q.row_count(ret_new, "retailer")))

        resolved = resolve_keys(rows, wh.read_date(spark), width, [c for c in ("_n", delivery, bid_col) if c], None if exceptions.isEmpty() else exceptions)
        lease.renew()
        given_rows = date_rows(resolved)
        touched = sorted(given_rows)
        existing = wh.read_sales_history(spark).where(F.col("DateId").isin(touched))
        stored_rows = date_rows(existing)
        shares = [(d, -(-(n + stored_rows.get(d, 0)) // TASK_ROWS)) for d, n in given_rows.items()]  # a row a touched week
        with sized_shuffles(spark, sum(stored_rows.values()) + (size or 0)), settings(spark, {ALL_KEYS: "false"}):
            shares = spark.createDataFrame(shares, "DateId long, _shares int")
            merged = staged(merge_fact(existing, resolved, ts, batch_id, delivery, bid_col, data_source, day, "_n", shares), "merged")
        reports.append(("sales", Q.gate_report(merged, SALES_TABLE, SALES_GATE)))
        for label, dim, new, id_col in ((PRODUCT_TABLE, prod_old, prod_new, "ProductId"), (RETAILER_TABLE, ret_old, ret_new, "RetailerId")):
            held = dim.select(id_col).unionByName(new.select(id_col))
            lost = orphans(merged.where("_action <> 'keep'"), held, id_col)
            reports.append((f"orphan_{id_col}", Q.none_left(lost, id_col, f"ETL: {SALES_TABLE} - {id_col} must be in the {label}")))

        # Every gate of every table in one job; the first failure in check order stops the load.
        found = Q.run_reports(reports)
        Q.raise_first(found)
        counts = {r["name"]: r["violations"] for r in found if r["check"] == "rows"}
        written = touched_date_ids(merged.where(F.col("_action").isin("insert", "update") | F.col("_noted")))
        publish(spark, wh, run, lease.renew)
        return LoadResult(touched, written, counts["new_products"], counts["new_retailers"], n_batches)
    finally:
        if enriched is not None:  # as large as the delivery, and of no use after the load, published or refused
            write_table(spark.createDataFrame([], enriched.schema), f"{stage}/enriched", "overwrite")


def run_weekly(
    spark: SparkSession,
    wh: Warehouse,
    path: str,
    batch_ts: _dt.datetime | str | None = None,
    data_source: str = DATA_SOURCE_MAT,
    bits: int | None = None,
) -> LoadResult:
    """Scan one weekly extract folder, register it as a batch (with or without rows), and load it.

    A folder named ``week=<yyyy-MM-dd>`` is the delivery of that date and takes its
    place among those loaded before; any other applies on arrival.
    """
    named = re.search(rf"(?:^|/){DELIVERY_COLUMN}=(\d{{4}}-\d{{2}}-\d{{2}})/*$", path)
    rows = read_extract(spark, path, with_file_path=True)
    rows = rows.withColumn("_folder", delivery_folder("file_path")).drop("file_path")
    return load_batch(spark, wh, rows, batch_ts, folder="_folder", folders=delivery_folders(spark, path), data_source=data_source, bits=bits,
                      day=_dt.date.fromisoformat(named[1]) if named else None, size=about_rows(spark, path))


def backfill(
    spark: SparkSession,
    wh: Warehouse,
    root: str,
    batch_ts: _dt.datetime | str | None = None,
    data_source: str = DATA_SOURCE_MAT,
    bits: int | None = None,
    folders: list[str] | None = None,
) -> LoadResult:
    """Load every delivery folder under ``root`` (or the given ones of them) in one pass.

    Equal to loading the folders one by one in date order, audit ids included: a
    fact key's deliveries are applied in order, with those loaded before, and a
    dimension member counts from its first delivery.  Loading them again changes nothing.  Audit times are those of this one run.  Unlike
    week-by-week loading, a bad delivery stops the whole run.
    """
    rows = read_deliveries(spark, root, folders).withColumn("_folder", delivery_folder(F.col("file_path"))).drop("file_path")
    given = delivery_folders(spark, folders or root)
    size = about_rows(spark, folders or root)
    return load_batch(spark, wh, rows, batch_ts, delivery=DELIVERY_COLUMN, folder="_folder", folders=given, data_source=data_source, bits=bits, size=size)
