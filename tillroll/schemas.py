"""Table schemas of the weekly-sales warehouse.

Column names, order and types are part of the contract: CSV extracts are
bound by position, warehouse tables are read with these schemas so that a
partition column (``DateId``) keeps its declared type.
"""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(13, 2)

# The source tag written on every fact row of the weekly broker
# extract, and the fact key.
DATA_SOURCE_MAT = "MAT"
FACT_KEY = ["DateId", "ProductId", "RetailerId"]
FACT_VALUES = ["DataSource", "SKU", "UnitsSold", "SalesAmount"]
AUDIT = ["CreatedTime", "CreatedByBatchId", "UpdatedTime", "UpdatedByBatchId"]

# Weekly extract as it arrives (CSV, bound by position, header skipped).
# Units arrive as a float figure and are truncated to int after the scan;
# Sales are read straight into DECIMAL(13,2) so no pence are lost in a float.
EXTRACT_CSV = StructType(
    [
        StructField("SKU", LongType()),
        StructField("Retailer", StringType()),
        StructField("Week Ending", DateType()),
        StructField("Units", DoubleType()),
        StructField("Sales", MONEY),
    ]
)

SKU_MAPPER = StructType(
    [
        StructField("SKU", LongType()),
        StructField("Retailer", StringType()),
        StructField("Description", StringType()),
        StructField("ProductType", StringType()),
    ]
)

_AUDIT_FIELDS = [
    StructField("CreatedTime", TimestampType()),
    StructField("CreatedByBatchId", IntegerType()),
    StructField("UpdatedTime", TimestampType()),
    StructField("UpdatedByBatchId", IntegerType()),
]

PRODUCT = StructType(
    [
        StructField("ProductId", LongType()),
        StructField("ProductName", StringType()),
        StructField("ProductType", StringType()),
        *_AUDIT_FIELDS,
    ]
)

RETAILER = StructType(
    [
        StructField("RetailerId", LongType()),
        StructField("RetailerName", StringType()),
        *_AUDIT_FIELDS,
    ]
)

SALES = StructType(
    [
        StructField("DateId", LongType()),
        StructField("ProductId", LongType()),
        StructField("RetailerId", LongType()),
        StructField("DataSource", StringType()),
        StructField("SKU", LongType()),
        StructField("UnitsSold", IntegerType()),
        StructField("SalesAmount", MONEY),
        *_AUDIT_FIELDS,
    ]
)

# What a fact row keeps beside its contract columns: the deliveries that gave it values, oldest first.
HISTORY = "Deliveries"
STEP = StructType(
    [
        StructField("ord", DateType()),
        StructField("bid", IntegerType()),
        StructField("DataSource", StringType()),
        StructField("SKU", LongType()),
        StructField("UnitsSold", IntegerType()),
        StructField("SalesAmount", MONEY),
    ]
)
SALES_WITH_HISTORY = StructType([*SALES.fields, StructField(HISTORY, ArrayType(STEP))])

DATE_DIM = StructType(
    [
        StructField("DateId", LongType()),
        StructField("Date", DateType()),
        StructField("WeekEnding", DateType()),
        StructField("WeekCommencing", DateType()),
        StructField("DayOfWeekName", StringType()),
        StructField("DayOfWeekNumber", IntegerType()),
        StructField("DayOfMonth", IntegerType()),
        StructField("DayOfYear", IntegerType()),
        StructField("MonthName", StringType()),
        StructField("MonthNumber", IntegerType()),
        StructField("QuarterNumber", IntegerType()),
        StructField("QuarterPresentation", StringType()),
        StructField("Year", IntegerType()),
    ]
)

BATCH = StructType(
    [
        StructField("BatchId", LongType()),
        StructField("DataSource", StringType()),
        StructField("FilePath", StringType()),
    ]
)

# Members whose id isn't the plain function of their name (see functions.keys).
KEY_EXCEPTIONS = StructType(
    [StructField("Kind", StringType()), StructField("Name", StringType()), StructField("Id", LongType())]
)

# Stored properties of a warehouse, and the log of its publishing runs.
PROPERTIES = StructType([StructField("Name", StringType()), StructField("Value", LongType())])
RUNS = StructType([StructField("Run", StringType()), StructField("State", StringType())])
