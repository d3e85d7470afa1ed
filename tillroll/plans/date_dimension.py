"""Date dimension: one row per day in [start, end), 13 columns, one projection."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import date_parts, date_range
from ..sources.tables import write_table


def build_date_dimension(spark: SparkSession, start: str | _dt.date, end: str | _dt.date) -> DataFrame:
    """The calendar for ``[start, end)`` (``dd/MM/yyyy`` strings or dates); empty if start >= end."""
    return date_range(spark, start, end).select(*date_parts("Date"))


def write_date_dimension(spark: SparkSession, path: str, start: str | _dt.date, end: str | _dt.date) -> None:
    write_table(build_date_dimension(spark, start, end), path, "overwrite")
