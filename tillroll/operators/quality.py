"""Quality gates: uniqueness and not-null checks that stop a load.

A gate is a list of checks over one table.  All checks of a table are
computed in ONE aggregation pass (``gate_report``); the first violated check
in list order raises ``GateError`` with the message text of the contract.

Semantics kept from the warehouse contract:
* uniqueness counts null as a value (``count(*)`` vs. distinct rows of the
  columns - ``count(DISTINCT c)`` would ignore nulls and is not used);
* a violated check reports how many rows break it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(Exception):
    """A quality gate failed; nothing after it may be written."""


@dataclass(frozen=True)
class Check:
    kind: str  # "unique" | "not_null" | "counted"
    columns: tuple[str, ...]
    count_column: str | None = None  # "counted": per-row number of repeats; "not_null": rows each row stands for

    def message(self, table: str) -> str:
        # The message texts of the gate contract.
        if self.kind == "not_null":
            return f"ETL: {table} - {self.columns[0]} must NOT have null values"
        if len(self.columns) == 1:
            return f"ETL: {table} - {self.columns[0]} must NOT have duplicates"
        return f"ETL: {table} - List({', '.join(self.columns)}) must NOT have duplicates"

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def unique(*columns: str) -> Check:
    return Check("unique", tuple(columns))


def not_null(column: str, weight: str | None = None) -> Check:
    """Column has no nulls; ``weight`` names a column giving how many rows each row stands for."""
    return Check("not_null", (column,), weight)


def unique_by_count(columns: Sequence[str], count_column: str) -> Check:
    """Uniqueness already counted per row (``count_column`` = rows repeating this row's key).

    Used by the fact merge, whose aggregation by key already sees every copy
    of a key, so the check costs no second shuffle.
    """
    return Check("counted", tuple(columns), count_column)


def _violations(df: DataFrame, check: Check) -> Column:
    if check.kind == "not_null":
        if check.count_column:
            return F.sum(F.when(F.col(check.columns[0]).isNull(), F.col(check.count_column)).otherwise(0))
        return F.count_if(F.col(check.columns[0]).isNull())
    if check.kind == "counted":
        return F.coalesce(F.sum(check.count_column), F.lit(0))
    key = F.struct(*[F.col(c) for c in check.columns])
    return F.count(F.lit(1)) - F.count_distinct(key)


def gate_report(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``seq, check, columns, violations, message`` (message null if it passes).

    Lazy; all checks share one aggregation over ``df``.
    """
    wide = df.agg(*[F.coalesce(_violations(df, c).cast("long"), F.lit(0).cast("long")).alias(f"v{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("seq"),
            F.lit(c.kind if c.kind != "counted" else "unique").alias("check"),
            F.lit(c.label).alias("columns"),
            F.col(f"v{i}").alias("violations"),
            F.when(F.col(f"v{i}") > 0, F.lit(c.message(table))).alias("message"),
        )
        for i, c in enumerate(checks)
    ]
    return wide.select(F.inline(F.array(*rows)))


def row_count(df: DataFrame, label: str) -> DataFrame:
    """A report-shaped row holding ``count(*)`` of ``df`` (check ``rows``, never a failure)."""
    return df.agg(
        F.lit(0).alias("seq"),
        F.lit("rows").alias("check"),
        F.lit(label).alias("columns"),
        F.count(F.lit(1)).cast("long").alias("violations"),
        F.lit(None).cast("string").alias("message"),
    )


def none_left(df: DataFrame, columns: str, message: str) -> DataFrame:
    """A report row that fails with ``message`` if ``df`` has any row."""
    n = F.count(F.lit(1)).cast("long")
    return df.agg(
        F.lit(1).alias("seq"),
        F.lit("none").alias("check"),
        F.lit(columns).alias("columns"),
        n.alias("violations"),
        F.when(n > 0, F.lit(message)).alias("message"),
    )


def run_reports(reports: Sequence[tuple[str, DataFrame]]) -> list:
    """Evaluate several reports in ONE job; rows come back tagged with their report name.

    The reports are independent aggregations, so Spark runs them as
    concurrent stages of a single job instead of one job each.
    """
    tagged = None
    for order, (name, rep) in enumerate(reports):
        part = rep.select(F.lit(order).alias("report"), F.lit(name).alias("name"), "*")
        tagged = part if tagged is None else tagged.unionByName(part)
    return sorted(tagged.collect(), key=lambda r: (r["report"], r["seq"]))


def raise_first(report_rows) -> None:
    """Raise the first violated check of collected report rows (in ``seq`` order)."""
    for row in report_rows:
        if row["check"] != "rows" and row["violations"] and row["violations"] > 0:
            raise GateError(row["message"])


def enforce(df: DataFrame, table: str, checks: Sequence[Check]) -> None:
    """Run the gate (one job) and raise the first failure."""
    raise_first(sorted(gate_report(df, table, checks).collect(), key=lambda r: r["seq"]))


# The single-check forms of the contract.

def check_unique(df: DataFrame, column: str, table: str) -> None:
    enforce(df, table, [unique(column)])


def check_unique_columns(df: DataFrame, columns: Sequence[str], table: str) -> None:
    enforce(df, table, [unique(*columns)])


def check_not_null(df: DataFrame, column: str, table: str) -> None:
    enforce(df, table, [not_null(column)])


def max_or_zero(df: DataFrame, column: str) -> DataFrame:
    """One row, one column ``max_value``: 0 if ``df`` has no rows, else ``max(column)``.

    A non-empty table whose column is all null yields null, as in the
    contract.  One pass.
    """
    return df.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(0))
        .otherwise(F.max(column))
        .alias("max_value")
    )
