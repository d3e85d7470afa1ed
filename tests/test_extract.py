import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from fixtures import SCAN_PARTS, SUNDAY1, SUNDAY2, WEEK1, write_csv
from tillroll.functions.money import line_amount
from tillroll.sources.extract import delivery_folders, export_extract, read_deliveries, read_export_order, read_extract, read_extract_lines


def test_scan_reads_every_part_file(spark, tmp_root):
    folder = f"{tmp_root}/read_sample_file"
    for i, line in enumerate(SCAN_PARTS):
        write_csv(folder, [line], name=f"part-{i:05d}.csv", newline_at_end=True)
    df = read_extract(spark, folder)
    assert df.count() == 12
    types = {f.name: f.dataType.typeName() for f in df.schema}
    assert types == {"SKU": "long", "Retailer": "string", "Week Ending": "date", "Units": "integer", "Sales": "decimal"}
    assert [r[0] for r in df.select("Week Ending").distinct().collect()] == [SUNDAY1]


def test_header_is_skipped_not_matched(spark, tmp_root):
    folder = f"{tmp_root}/odd_header"
    with open(write_csv(folder, []) + "/figures.csv", "w") as fh:
        fh.write("X,Y,Z,U,V\n52,Halden,5/3/2023,40.7,61.25")
    row = read_extract(spark, folder).first()
    assert (row["SKU"], row["Retailer"], row["Week Ending"], row["Units"]) == (52, "Halden", SUNDAY1, 40)
    assert row["Sales"] == decimal.Decimal("61.25")


def test_permissive_rows_become_null(spark, tmp_root):
    folder = write_csv(
        f"{tmp_root}/bad",
        ["abc,Halden,31/02/2023,-3.9,1.005", "710,Northgate,2023-03-05,1e12,200000.01", "9,Ostrava"],
    )
    rows = {r["Retailer"]: r for r in read_extract(spark, folder).collect()}
    assert len(rows) == 3
    assert rows["Halden"]["SKU"] is None and rows["Halden"]["Week Ending"] is None
    assert rows["Halden"]["Units"] == -3  # truncated toward zero
    assert rows["Northgate"]["Week Ending"] is None  # ISO date does not match d/M/y
    assert rows["Northgate"]["Units"] is None  # overflow -> null, never an error
    assert rows["Northgate"]["Sales"] == decimal.Decimal("200000.01")  # no float rounding
    assert rows["Ostrava"]["Units"] is None and rows["Ostrava"]["Sales"] is None


def test_export_round_trip(spark, tmp_root):
    src = spark.createDataFrame(
        [(r * 10 + k, f"Retailer {r}", day, 5 * k + 1, decimal.Decimal(f"{k}.2{r}")) for r in range(3) for k in range(20, 0, -1) for day in (SUNDAY1, SUNDAY2)],
        "SKU long, Retailer string, `Week Ending` date, Units int, Sales decimal(13,2)",
    )
    root = f"{tmp_root}/export"
    export_extract(src, root)
    back = read_extract(spark, root)
    assert sorted(back.collect()) == sorted(src.collect())
    lines = {(r["folder"], r["line"]) for r in read_extract_lines(spark, root).collect()}
    assert ("week=2023-03-05", "1,Retailer 0,05/03/2023,6,1.20") in lines and len(lines) == 120
    assert {(r["week"], r["Week Ending"]) for r in read_deliveries(spark, root).collect()} == {(d, d) for d in (SUNDAY1, SUNDAY2)}
    order = read_export_order(spark, root).collect()
    assert len(order) == 120 and all(r["in_order"] for r in order)


def hot_week(spark, n):
    """A week with all but twenty of ``n`` rows, out of order."""
    day = F.when(F.col("id") < n - 20, F.lit(SUNDAY1)).otherwise(F.lit(SUNDAY2)).alias("Week Ending")
    name = F.concat(F.lit("Shop "), F.col("id") % 7).alias("Retailer")
    return spark.range(n).select((F.col("id") * 7919 % n).alias("SKU"), name, day, F.lit(1).alias("Units"), F.lit(1).cast("decimal(13,2)").alias("Sales"))


def test_a_hot_week_gives_bounded_sorted_files(spark, tmp_root):
    root = f"{tmp_root}/hot"
    export_extract(hot_week(spark, 5000), root, file_rows=700)
    files = read_extract(spark, root, with_file_path=True).groupBy("file_path").count().collect()
    assert sum(r["count"] for r in files) == 5000 and max(r["count"] for r in files) <= 700
    assert read_export_order(spark, root).where("in_order").count() == 5000


@pytest.mark.parametrize("block", ["128m", "512b"])
def test_order_is_checked_across_blocks(spark, tmp_root, block):
    lines = [f"{i},Shop,05/03/2023,1,1.00" for i in range(1000)]
    lines[300], lines[700] = lines[700], lines[300]  # after each of the two, a line falls back
    lines += ['5,"Shop, old",05/03/2023,1,1.00', ",Shopp,05/03/2023,1,1.00", "4,Shopp,05/03/2023,1,1.00"]
    write_csv(f"{tmp_root}/x/week=2023-03-05", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        wrong = sorted(r["line"] for r in read_export_order(spark, f"{tmp_root}/x").where("not in_order").collect())
        assert read_export_order(spark, f"{tmp_root}/x").count() == 1003
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert wrong == sorted([lines[301], lines[700]])


def test_folders_come_from_the_listing(spark, tmp_root):
    write_csv(f"{tmp_root}/in/week=2023-03-05", WEEK1)
    write_csv(f"{tmp_root}/in/week=2023-03-12", [])
    found = sorted(r.FilePath.rsplit("/", 1)[-1] for r in delivery_folders(spark, f"{tmp_root}/in").collect())
    assert found == ["week=2023-03-05", "week=2023-03-12"]


def test_line_amount_multiplies_the_price_as_it_is(spark):
    rows = spark.createDataFrame([(0.333333, 3000), (1.005, 1), (1e14, 9), (None, 1)], "p double, n int")
    got = [r.a for r in rows.select(line_amount("p", "n").alias("a")).collect()]
    assert got == [decimal.Decimal("1000.00"), decimal.Decimal("1.01"), None, None]
