import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tillroll.operators import quality as Q
from tillroll.sources.tables import read_or_empty, write_table

SKU_RETAILER = StructType([StructField("SKU", IntegerType()), StructField("Retailer", StringType())])
NAME_DATE_COMPANY = StructType(
    [StructField("Name", StringType()), StructField("DateId", IntegerType()), StructField("Company", StringType())]
)


def test_unique_column(spark):
    dup = spark.createDataFrame([(1, "Halden"), (2, "Northgate"), (3, "Halden")], SKU_RETAILER)
    with pytest.raises(Q.GateError) as err:
        Q.check_unique(dup, "Retailer", "myTable")
    assert str(err.value) == "ETL: myTable - Retailer must NOT have duplicates"
    Q.check_unique(spark.createDataFrame([(1, "Halden"), (2, "Northgate")], SKU_RETAILER), "Retailer", "myTable")


def test_unique_columns(spark):
    dup = spark.createDataFrame([("Test1", 1, "Halden"), ("Test1", 2, "Halden"), ("Test1", 1, "Halden")], NAME_DATE_COMPANY)
    with pytest.raises(Q.GateError) as err:
        Q.check_unique_columns(dup, ["Name", "DateId", "Company"], "myTable")
    assert str(err.value) == "ETL: myTable - List(Name, DateId, Company) must NOT have duplicates"
    ok = spark.createDataFrame([("Test1", 1, "Halden"), ("Test1", 2, "Halden"), ("Test1", 3, "Halden")], NAME_DATE_COMPANY)
    Q.check_unique_columns(ok, ["Name", "DateId", "Company"], "myTable")


def test_not_null(spark):
    bad = spark.createDataFrame([(1, "Halden"), (2, None), (3, "Halden")], SKU_RETAILER)
    with pytest.raises(Q.GateError) as err:
        Q.check_not_null(bad, "Retailer", "myTable")
    assert str(err.value) == "ETL: myTable - Retailer must NOT have null values"
    Q.check_not_null(spark.createDataFrame([(1, "Halden"), (2, "Northgate")], SKU_RETAILER), "Retailer", "myTable")


def test_uniqueness_counts_null_as_a_value(spark):
    two_nulls = spark.createDataFrame([(1, None), (2, None)], SKU_RETAILER)
    with pytest.raises(Q.GateError):
        Q.check_unique(two_nulls, "Retailer", "t")


def test_report_order_first_failure_wins(spark):
    df = spark.createDataFrame([(1, None), (1, "Halden")], SKU_RETAILER)
    checks = [Q.unique("SKU"), Q.not_null("Retailer")]
    rows = sorted(Q.gate_report(df, "t", checks).collect(), key=lambda r: r["seq"])
    assert [r["violations"] for r in rows] == [1, 1]
    with pytest.raises(Q.GateError) as err:
        Q.enforce(df, "t", checks)
    assert "SKU must NOT have duplicates" in str(err.value)


def test_max_or_zero(spark):
    df = spark.createDataFrame([(1, "Halden"), (2, "Northgate"), (3, "Halden")], SKU_RETAILER)
    assert Q.max_or_zero(df, "SKU").first()["max_value"] == 3
    assert Q.max_or_zero(spark.createDataFrame([], SKU_RETAILER), "SKU").first()["max_value"] == 0
    all_null = spark.createDataFrame([(None, "x")], SKU_RETAILER)
    assert Q.max_or_zero(all_null, "SKU").first()["max_value"] is None


def test_read_or_empty(spark, tmp_root):
    with_data = f"{tmp_root}/with_data"
    write_table(spark.createDataFrame([(1, "Halden"), (2, "Northgate"), (3, "Halden")], SKU_RETAILER), with_data, "overwrite")
    df = read_or_empty(spark, with_data, SKU_RETAILER)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SKU_RETAILER] and df.count() == 3

    import os

    empty_dir = f"{tmp_root}/no_data"
    os.makedirs(empty_dir)
    df = read_or_empty(spark, empty_dir, SKU_RETAILER)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SKU_RETAILER] and df.count() == 0

    df = read_or_empty(spark, f"{tmp_root}/no_folder", SKU_RETAILER)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SKU_RETAILER] and df.count() == 0


def test_overwrite_refuses_own_input(spark, tmp_root):
    path = f"{tmp_root}/t"
    write_table(spark.createDataFrame([(1, "Halden")], SKU_RETAILER), path, "overwrite")
    with pytest.raises(ValueError):
        write_table(read_or_empty(spark, path, SKU_RETAILER), path, "overwrite")
    assert read_or_empty(spark, path, SKU_RETAILER).count() == 1
