"""The weekly-sales model derived from the transaction tables.

Mapping (one row of the weekly extract = one supplier's sales of one part in
one week):

* ``SKU``         = ``l_partkey`` (unique within a retailer)
* ``Retailer``    = ``s_name`` of ``l_suppkey``
* ``Week Ending`` = Sunday on or after ``l_shipdate``
* ``Units``       = ``sum(l_quantity)`` as INT
* ``Sales``       = ``sum(l_extendedprice)`` summed as DECIMAL(13,2)
* SKU mapper: ``Description`` = ``p_name || ' #' || p_partkey`` (plain part
  names repeat across parts), ``ProductType`` = ``p_type``

Plan shape: lineitem is aggregated to the extract grain FIRST (partial
aggregation before the shuffle, keyed on week, part and supplier together,
so a hot part or supplier is spread and pre-combined), and only the
aggregated rows meet the supplier and part tables.  After aggregation a part
key repeats at most (#weeks x #suppliers) times, so no join key is hot.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import week_ending
from ..functions.money import to_money

# The restatement scenario used by the example loads.  The
# broker first delivers gross figures; from RESTATE_FROM it re-delivers
# figures net of returned lines (l_returnflag = 'R') and discounts, and the first delivery
# stops before FIRST_DELIVERY_UNTIL, so the weeks in between arrive twice,
# some unchanged and some restated.
RETURNED_FLAG = "R"
RESTATE_FROM = _dt.date(1998, 7, 5)
FIRST_DELIVERY_UNTIL = _dt.date(1999, 1, 3)


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def weekly_extract(
    lineitem: DataFrame,
    supplier: DataFrame,
    restated: bool = False,
    weeks_from: _dt.date | None = None,
    weeks_before: _dt.date | None = None,
) -> DataFrame:
    """Weekly extract rows (SKU, Retailer, Week Ending, Units, Sales) from the transaction tables.

    ``restated``: figures net of returns and discounts - returned lines are
    left out (a part-week whose lines were all returned disappears) and each
    line counts ``price * (1 - discount)``, in exact decimal arithmetic.

    ``weeks_from`` / ``weeks_before`` (Sundays) keep the weeks ending in
    ``[weeks_from, weeks_before)``.  They are applied to the raw ship date
    (a week ending on Sunday W holds the days W-6 .. W), so the bound reaches
    the Parquet scan and rows are dropped before the aggregation shuffle.
    """
    price = to_money("l_extendedprice")
    if restated:
        price = price * (F.lit(1) - to_money("l_discount"))
    raw = lineitem
    if weeks_from is not None:
        raw = raw.where(F.col("l_shipdate") >= F.lit(weeks_from - _dt.timedelta(days=6)))
    if weeks_before is not None:
        raw = raw.where(F.col("l_shipdate") < F.lit(weeks_before - _dt.timedelta(days=6)))
    li = raw.select(
        "l_partkey",
        "l_suppkey",
        week_ending(F.to_date("l_shipdate")).alias("week"),
        F.col("l_quantity"),
        price.alias("price"),
        F.col("l_returnflag"),
    )
    if restated:
        li = li.where(~F.col("l_returnflag").eqNullSafe(F.lit(RETURNED_FLAG)))
    if weeks_from is not None:
        li = li.where(F.col("week") >= F.lit(weeks_from))
    if weeks_before is not None:
        li = li.where(F.col("week") < F.lit(weeks_before))
    grain = li.groupBy("week", "l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("units"),
        F.sum("price").alias("sales"),
    )
    sup = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("Retailer"))
    return grain.join(sup, "l_suppkey", "left").select(
        F.col("l_partkey").cast("long").alias("SKU"),
        "Retailer",
        F.col("week").alias("Week Ending"),
        F.col("units").try_cast("int").alias("Units"),
        F.col("sales").try_cast("decimal(13,2)").alias("Sales"),
    )


def sku_mapper(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """(SKU, Retailer) -> (Description, ProductType) for every part a supplier has sold."""
    pairs = lineitem.select("l_partkey", "l_suppkey").distinct()
    prt = part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("Description"),
        F.col("p_type").alias("ProductType"),
    )
    sup = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("Retailer"))
    return (
        pairs.join(prt, "l_partkey", "inner")
        .join(sup, "l_suppkey", "inner")
        .select(F.col("l_partkey").cast("long").alias("SKU"), "Retailer", "Description", "ProductType")
    )


def first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch A: gross figures for the weeks before ``FIRST_DELIVERY_UNTIL``."""
    lineitem, supplier = _tables(spark, sf_dir, "lineitem", "supplier")
    return weekly_extract(lineitem, supplier, weeks_before=FIRST_DELIVERY_UNTIL)


def restated_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch B: figures net of returns and discounts from ``RESTATE_FROM`` on (overlaps batch A)."""
    lineitem, supplier = _tables(spark, sf_dir, "lineitem", "supplier")
    return weekly_extract(lineitem, supplier, restated=True, weeks_from=RESTATE_FROM)


def full_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, supplier = _tables(spark, sf_dir, "lineitem", "supplier")
    return weekly_extract(lineitem, supplier)


def mapper_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part, supplier = _tables(spark, sf_dir, "lineitem", "part", "supplier")
    return sku_mapper(lineitem, part, supplier)


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple[_dt.date, _dt.date]:
    """[1 Jan of the first shipping year, 1 Jan after the last) - one tiny aggregate."""
    (lineitem,) = _tables(spark, sf_dir, "lineitem")
    row = lineitem.agg(F.to_date(F.min("l_shipdate")).alias("lo"), F.to_date(F.max("l_shipdate")).alias("hi")).first()
    return _dt.date(row["lo"].year, 1, 1), _dt.date(row["hi"].year + 1, 1, 1)
