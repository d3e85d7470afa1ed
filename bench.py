"""Benchmark: headline stages of the weekly-sales warehouse at one scale.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries": {stage: sec}, "sf", ...}.

Every stage starts from the driver tables (nothing memoised between stages
except the warehouse a stage builds on); DataFrame results are fully
materialised through Spark's ``noop`` sink, never collected.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tillroll.catalog import DELIVERY_A, DELIVERY_B, TS_A, TS_B, TS_C  # noqa: E402
from tillroll.functions.keys import WIDE_BITS  # noqa: E402
from tillroll.operators import quality as Q  # noqa: E402
from tillroll.operators.dimensions import PRODUCT_GATE, PRODUCT_TABLE, gate_scope, new_members, product_candidates, settle_ids  # noqa: E402
from tillroll.operators.fact import conform_extract, enrich_extract  # noqa: E402
from tillroll.operators.views import view_sales  # noqa: E402
from tillroll.plans.date_dimension import build_date_dimension, write_date_dimension  # noqa: E402
from tillroll.plans.weekly_load import backfill, run_weekly  # noqa: E402
from tillroll.session import local_session, scratch_dir  # noqa: E402
from tillroll.sources import retail_model as RM  # noqa: E402
from tillroll.sources.extract import export_extract  # noqa: E402
from tillroll.sources.tables import Warehouse, publish_lookup, write_table  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    lo, hi = RM.calendar_bounds(spark, sf_dir)
    _noop(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))  # warm the JVM and file cache once

    timed("weekly_extract", lambda: _noop(RM.full_extract(spark, sf_dir)))
    timed("date_dimension", lambda: _noop(build_date_dimension(spark, lo, hi)))

    def setup_lake(label):
        wh = Warehouse(scratch_dir(spark, label))
        write_date_dimension(spark, wh.date, lo, hi)
        publish_lookup(RM.mapper_for(spark, sf_dir), wh.sku_mapper, wh.sku_mapper_raw)
        return wh

    timed("publish_lookups", lambda: setup_lake("bench-lookups"))

    def load_product():
        """The product part of a load: members found and settled, staged, gated, appended."""
        wh = setup_lake("bench-product")
        enriched = enrich_extract(conform_extract(RM.full_extract(spark, sf_dir)), wh.read_sku_mapper(spark))
        old = wh.read_product(spark)
        stage = wh.stage("bench")
        write_table(new_members(product_candidates(enriched), old, "ProductName", "ProductId", TS_A), f"{stage}/found", "overwrite")
        fresh, _ = settle_ids(spark.read.parquet(f"{stage}/found"), old, "ProductName", "ProductId", WIDE_BITS)
        Q.enforce(gate_scope(fresh, old, "ProductId"), PRODUCT_TABLE, PRODUCT_GATE)
        write_table(fresh, wh.product, "append")

    timed("load_product", load_product)

    deliveries = scratch_dir(spark, "bench-deliveries")

    def export():
        a = RM.first_delivery(spark, sf_dir).withColumn("_d", F.lit(DELIVERY_A))
        b = RM.restated_delivery(spark, sf_dir).withColumn("_d", F.lit(DELIVERY_B))
        export_extract(a.unionByName(b), deliveries, delivery="_d")

    timed("export_extract", export)
    wh = setup_lake("bench-lake")
    folder_a = f"{deliveries}/week={DELIVERY_A.isoformat()}"
    folder_b = f"{deliveries}/week={DELIVERY_B.isoformat()}"
    timed("first_load", lambda: run_weekly(spark, wh, folder_a, TS_A))
    timed("upsert_sales", lambda: run_weekly(spark, wh, folder_b, TS_B))
    timed("upsert_replay", lambda: run_weekly(spark, wh, folder_b, TS_C))
    timed(
        "view_sales",
        lambda: _noop(view_sales(wh.read_sales(spark), wh.read_product(spark), wh.read_retailer(spark), wh.read_date(spark))),
    )
    wh2 = setup_lake("bench-backfill")
    timed("backfill_weeks", lambda: backfill(spark, wh2, deliveries, TS_A))

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "weekly_warehouse_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
