"""tillroll: a weekly-sales warehouse built as Spark DataFrame plans.

Typical use (the caller owns the session)::

    from tillroll import Warehouse, write_date_dimension, publish_lookup, run_weekly, view_sales

    wh = Warehouse("hdfs:///lake/retail")               # a shared file system that renames atomically
    write_date_dimension(spark, wh.date, "01/01/2022", "01/01/2023")
    publish_lookup(sku_mapper_df, wh.sku_mapper, wh.sku_mapper_raw)
    run_weekly(spark, wh, "hdfs:///lake/deliveries/week=2022-01-02")
    view_sales(wh.read_sales(spark), wh.read_product(spark), wh.read_retailer(spark), wh.read_date(spark))
"""

from .operators.quality import GateError
from .operators.views import view_product, view_retailer, view_sales
from .plans.date_dimension import build_date_dimension, write_date_dimension
from .plans.weekly_load import backfill, load_batch, run_weekly
from .sources.extract import export_extract, read_deliveries, read_extract
from .sources.tables import Warehouse, publish_lookup, read_or_empty, write_table

__all__ = [
    "GateError",
    "Warehouse",
    "backfill",
    "build_date_dimension",
    "export_extract",
    "load_batch",
    "publish_lookup",
    "read_deliveries",
    "read_extract",
    "read_or_empty",
    "run_weekly",
    "view_product",
    "view_retailer",
    "view_sales",
    "write_date_dimension",
    "write_table",
]
