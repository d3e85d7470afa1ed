"""Table equality as a multiset difference.

``table_diff(a, b)`` is ``a EXCEPT ALL b`` and ``b EXCEPT ALL a`` together,
reported with multiplicities instead of repeated rows: each distinct row
whose count differs appears once, with ``side`` ('left_only' / 'right_only')
and ``copies`` (how many more times that side holds it).  The tables are
equal iff the result is empty.

One shuffle, with partial aggregation before it: a row repeated a billion
times costs one combined count per map task, never a billion-row group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    cols = a.columns
    tagged = a.select(*cols, F.lit(1).alias("_w")).unionByName(b.select(*cols, F.lit(-1).alias("_w")))
    counted = tagged.groupBy(*cols).agg(F.sum("_w").alias("_net"))
    return counted.where(F.col("_net") != 0).select(
        *cols,
        F.when(F.col("_net") > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias("side"),
        F.abs(F.col("_net")).cast("long").alias("copies"),
    )


def tables_equal(a: DataFrame, b: DataFrame) -> bool:
    return table_diff(a, b).isEmpty()
