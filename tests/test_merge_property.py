"""Property test: the merge equals a plain-Python statement of the upsert rules."""

import datetime as dt
import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll import schemas
from tillroll.operators.fact import merge_fact

TS_OLD = dt.datetime(2022, 1, 1, 0, 0)
TS_NEW = dt.datetime(2022, 1, 8, 0, 0)
INCOMING = "DateId long, ProductId long, RetailerId long, DataSource string, SKU long, UnitsSold int, SalesAmount decimal(13,2), d date, b int"

keys = st.tuples(st.sampled_from([20220102, 20220109]), st.integers(1, 3), st.integers(1, 2))
values = st.tuples(st.sampled_from(["MAT", None]), st.sampled_from([1, 2]), st.sampled_from([5, None]),
                   st.sampled_from([decimal.Decimal("1.00"), decimal.Decimal("2.50")]))


def model(old, new):
    """Expected rows: a key's deliveries applied in order; rows without change keep their audit; others stay."""
    out = {k: [v, TS_OLD, None, 1, None, "keep"] for k, v in old.items()}
    for k, v, d in sorted(new, key=lambda x: x[2]):
        batch = 7 if d == dt.date(2022, 1, 9) else 8
        if k not in out:
            out[k] = [v, TS_NEW, None, batch, None, "insert"]
        elif out[k][0] != v:
            action = "insert" if out[k][5] == "insert" else "update"
            out[k] = [v, out[k][1], TS_NEW, out[k][3], batch, action]
        elif out[k][5] == "keep":
            out[k][5] = "unchanged"
    return {k: tuple(v) for k, v in out.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    old=st.dictionaries(keys, values, max_size=5),
    new=st.lists(st.tuples(keys, values, st.sampled_from([dt.date(2022, 1, 9), dt.date(2022, 1, 16)])), max_size=6,
                 unique_by=lambda t: (t[0], t[2])),
)
def test_merge_matches_model(spark, old, new):
    old_rows = [(*k, *v, TS_OLD, 1, None, None) for k, v in old.items()]
    new_rows = [(*k, *v, d, 7 if d == dt.date(2022, 1, 9) else 8) for k, v, d in new]
    existing = spark.createDataFrame(old_rows, schemas.SALES)
    incoming = spark.createDataFrame(new_rows, INCOMING)
    merged = merge_fact(existing, incoming, "2022-01-08 00:00:00", 2, delivery="d", batch_id_col="b").collect()
    got = {
        (r["DateId"], r["ProductId"], r["RetailerId"]): (
            (r["DataSource"], r["SKU"], r["UnitsSold"], r["SalesAmount"]), r["CreatedTime"], r["UpdatedTime"],
            r["CreatedByBatchId"], r["UpdatedByBatchId"], r["_action"])
        for r in merged
    }
    assert len(got) == len(merged)  # one row per key
    assert not any(r["_extra"] for r in merged)  # each delivery holds a key once
    assert got == model(old, new)
