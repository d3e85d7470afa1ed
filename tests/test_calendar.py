import datetime as dt

from pyspark.sql import functions as F

from tillroll.functions.calendar import date_range, day_of_week_number, week_commencing, week_ending
from tillroll.plans.date_dimension import build_date_dimension
from tillroll import schemas

D = dt.date


def _one(spark, fn, day):
    return spark.createDataFrame([(day,)], "d date").select(fn("d").alias("x")).first()["x"]


def test_week_ending_and_commencing(spark):
    cases = [
        (D(2018, 1, 5), D(2018, 1, 7), D(2018, 1, 1)),
        (D(2022, 1, 1), D(2022, 1, 2), D(2021, 12, 27)),
        (D(2022, 1, 2), D(2022, 1, 2), D(2021, 12, 27)),
        (D(1983, 12, 31), D(1984, 1, 1), D(1983, 12, 26)),
        (D(2027, 3, 14), D(2027, 3, 14), D(2027, 3, 8)),
    ]
    for day, end, start in cases:
        assert _one(spark, week_ending, day) == end
        assert _one(spark, week_commencing, day) == start


def test_day_of_week_number(spark):
    days = [D(2022, 5, 2) + dt.timedelta(days=i) for i in range(7)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(day_of_week_number("d").alias("n"))
    assert sorted(r["n"] for r in df.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_null_date_gives_null(spark):
    df = spark.createDataFrame([(None,)], "d date")
    row = df.select(week_ending("d").alias("a"), week_commencing("d").alias("b"), day_of_week_number("d").alias("c")).first()
    assert row["a"] is None and row["b"] is None and row["c"] is None


def test_date_dimension_golden(spark):
    df = build_date_dimension(spark, "01/01/2022", "08/01/2022")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.DATE_DIM]
    rows = sorted(df.collect(), key=lambda r: r["DateId"])
    expected = [
        (20220101, D(2022, 1, 1), D(2022, 1, 2), D(2021, 12, 27), "Saturday", 6),
        (20220102, D(2022, 1, 2), D(2022, 1, 2), D(2021, 12, 27), "Sunday", 7),
        (20220103, D(2022, 1, 3), D(2022, 1, 9), D(2022, 1, 3), "Monday", 1),
        (20220104, D(2022, 1, 4), D(2022, 1, 9), D(2022, 1, 3), "Tuesday", 2),
        (20220105, D(2022, 1, 5), D(2022, 1, 9), D(2022, 1, 3), "Wednesday", 3),
        (20220106, D(2022, 1, 6), D(2022, 1, 9), D(2022, 1, 3), "Thursday", 4),
        (20220107, D(2022, 1, 7), D(2022, 1, 9), D(2022, 1, 3), "Friday", 5),
    ]
    assert len(rows) == 7
    for i, (r, e) in enumerate(zip(rows, expected), start=1):
        assert (r["DateId"], r["Date"], r["WeekEnding"], r["WeekCommencing"], r["DayOfWeekName"], r["DayOfWeekNumber"]) == e
        assert (r["DayOfMonth"], r["DayOfYear"], r["MonthName"], r["MonthNumber"]) == (i, i, "January", 1)
        assert (r["QuarterNumber"], r["QuarterPresentation"], r["Year"]) == (1, "Q1", 2022)


def test_date_range_end_exclusive_and_empty(spark):
    assert date_range(spark, "01/01/2022", "01/01/2023").count() == 365
    assert date_range(spark, "08/01/2022", "01/01/2022").count() == 0
    assert date_range(spark, "01/01/2022", "01/01/2022").count() == 0


def test_date_dimension_is_lazy_range(spark):
    plan = build_date_dimension(spark, "01/01/2022", "01/01/2023")._jdf.queryExecution().executedPlan().toString()
    assert "Range" in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
