"""Money and extract-figure expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

# Fixed value: how a week-ending date is written into a CSV extract.
EXTRACT_DATE_FORMAT = "dd/MM/yyyy"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_money(value: Column | str) -> Column:
    """DECIMAL(13,2), rounding half up; out of range -> null (never raises)."""
    return _c(value).try_cast(MONEY)


def to_units(value: Column | str) -> Column:
    """Whole units, truncated toward zero; out of range -> null (never raises)."""
    return _c(value).try_cast("int")


def line_amount(unit_price: Column | str, units: Column | str) -> Column:
    """round(price * units, 2): the price is multiplied as it is, to ten decimals; out of range -> null."""
    price, n = _c(unit_price).try_cast("decimal(24,10)"), _c(units).try_cast("decimal(10,0)")
    return F.round(price * n, 2).try_cast(MONEY)


def extract_date_text(date: Column | str) -> Column:
    """Week-ending date as written in a CSV extract (dd/MM/yyyy)."""
    return F.date_format(_c(date), EXTRACT_DATE_FORMAT)


def parse_date(text: Column | str, pattern: str = EXTRACT_DATE_FORMAT) -> Column:
    """Date of a text in ``pattern``; null if it isn't one."""
    return F.try_to_timestamp(_c(text), F.lit(pattern)).cast("date")
