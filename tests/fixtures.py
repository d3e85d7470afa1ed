"""Test inputs: a small mapper of our own and two weekly deliveries made from it."""

import datetime as dt
import os

from tillroll import schemas

HEADER = "SKU,Retailer,Week Ending,Units,Sales"
D = dt.date

LEMON, OAT, RYE, TEA = "Lemon Cordial 75cl", "Oat Biscuits", "Rye Loaf Small", "Green Tea 40"
MAPPER_ROWS = [
    (51, "Halden", LEMON, "Drinks"),
    (52, "Halden", OAT, "Snacks"),
    (710, "Northgate", LEMON, "Drinks"),
    (711, "Northgate", TEA, "Drinks"),
    (712, "Northgate", RYE, "Bread"),
    (9, "Ostrava Foods", OAT, "Snacks"),
    (10, "Ostrava Foods", RYE, "Bread"),
]


def line(sku, retailer, day, units, sales):
    return f"{sku},{retailer},{day:%d/%m/%Y},{units},{sales}"


SUNDAY1, SUNDAY2, SUNDAY3 = D(2023, 3, 5), D(2023, 3, 12), D(2023, 3, 19)
FIRST = [(52, "Halden", 40, "61.20"), (710, "Northgate", 15, "33.75")]
SECOND = [(52, "Halden", 44, "67.32"), (711, "Northgate", 8, "25.60"), (10, "Ostrava Foods", 21, "44.10")]
WEEK1 = [line(s, r, SUNDAY1, f"{u}.0", v) for s, r, u, v in FIRST]
WEEK2 = [line(s, r, SUNDAY2, f"{u}.0", v) for s, r, u, v in SECOND]
NAMES = {(s, r): (n, k) for s, r, n, k in MAPPER_ROWS}

# Twelve part files of one row each for the scan test.
SCAN_PARTS = [line(100 + 7 * i, f"Retailer {i % 4}", SUNDAY1, f"{3 * i + 1}.0", f"{1.1 * i + 2:.2f}") for i in range(12)]


def write_csv(folder: str, lines: list[str], name: str = "figures.csv", newline_at_end: bool = False) -> str:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join([HEADER, *lines]) + ("\n" if newline_at_end else ""))
    return folder


def warehouse_with_lookups(spark, wh, mapper_rows=None):
    from tillroll.plans.date_dimension import write_date_dimension
    from tillroll.sources.tables import publish_lookup

    write_date_dimension(spark, wh.date, "01/01/2023", "01/01/2024")
    mapper = spark.createDataFrame(mapper_rows or MAPPER_ROWS, schemas.SKU_MAPPER)
    publish_lookup(mapper, wh.sku_mapper, wh.sku_mapper_raw)
