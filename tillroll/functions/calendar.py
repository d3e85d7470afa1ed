"""Calendar functions: native column expressions, no UDFs.

Weeks run Monday to Sunday.  Every function maps a null date to null.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: argument format of the date-range builder.
RANGE_ARG_FORMAT = "%d/%m/%Y"  # dd/MM/yyyy


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def week_ending(date: Column | str) -> Column:
    """First Sunday on or after ``date``."""
    return F.next_day(F.date_sub(_c(date), 1), "Sun")


def week_commencing(date: Column | str) -> Column:
    """Last Monday on or before ``date``."""
    return F.date_sub(F.next_day(_c(date), "Mon"), 7)


def day_of_week_number(date: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(date)) + 1).cast("int")


def date_id(date: Column | str) -> Column:
    """yyyyMMdd as a long, e.g. 2022-01-02 -> 20220102."""
    d = _c(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def date_parts(date: Column | str) -> list[Column]:
    """The 13 columns of the date dimension, in table order."""
    d = _c(date)
    return [
        date_id(d).alias("DateId"),
        d.alias("Date"),
        week_ending(d).alias("WeekEnding"),
        week_commencing(d).alias("WeekCommencing"),
        F.date_format(d, "EEEE").alias("DayOfWeekName"),
        day_of_week_number(d).alias("DayOfWeekNumber"),
        F.dayofmonth(d).alias("DayOfMonth"),
        F.dayofyear(d).alias("DayOfYear"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.month(d).alias("MonthNumber"),
        F.quarter(d).alias("QuarterNumber"),
        F.date_format(d, "QQQ").alias("QuarterPresentation"),
        F.year(d).alias("Year"),
    ]


def parse_range_arg(value: str | _dt.date) -> _dt.date:
    if isinstance(value, _dt.date):
        return value
    return _dt.datetime.strptime(value, RANGE_ARG_FORMAT).date()


def date_range(spark: SparkSession, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """One row per day in ``[start, end)``; empty when ``start >= end``.

    Generated by ``spark.range`` so the rows are produced in parallel on the
    executors, never as a driver-side list.
    """
    first, stop = parse_range_arg(start), parse_range_arg(end)
    days = max((stop - first).days, 0)
    return spark.range(0, days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("Date")
    )


def is_week_end(date: Column | str) -> Column:
    """True on Sundays (the day a weekly extract is dated)."""
    return F.weekday(_c(date)) == 6
