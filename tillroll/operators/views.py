"""Read views: names instead of ids, ordered at the consumer edge.

All lazy: nothing is collected to the driver.  The sales view is one star
join; the calendar (a row a day: bounded by its years) is broadcast, and the dimensions are
left to the planner (a large product dimension is a shuffle join, and a hot
product is split by adaptive skew-join handling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The view's columns in order.
SALES_VIEW_COLUMNS = ["Date", "ProductName", "RetailerName", "DataSource", "SKU", "UnitsSold", "SalesAmount"]


def view_retailer(retailer: DataFrame, with_ids: bool = False) -> DataFrame:
    cols = (["RetailerId"] if with_ids else []) + ["RetailerName"]
    return retailer.select(*cols).orderBy("RetailerName")


def view_product(product: DataFrame, with_ids: bool = False) -> DataFrame:
    cols = (["ProductId"] if with_ids else []) + ["ProductName", "ProductType"]
    return product.select(*cols).orderBy("ProductName")


def view_sales(sales: DataFrame, product: DataFrame, retailer: DataFrame, dates: DataFrame, ordered: bool = True) -> DataFrame:
    """Date, ProductName, RetailerName, DataSource, SKU, UnitsSold, SalesAmount (inner star join)."""
    facts = sales.select("DateId", "ProductId", "RetailerId", "DataSource", "SKU", "UnitsSold", "SalesAmount")
    out = (
        facts.join(product.select("ProductId", "ProductName"), "ProductId", "inner")
        .join(retailer.select("RetailerId", "RetailerName"), "RetailerId", "inner")
        .join(F.broadcast(dates.select("DateId", "Date")), "DateId", "inner")
        .select(*SALES_VIEW_COLUMNS)
    )
    return out.orderBy("Date", "ProductName", "RetailerName") if ordered else out
