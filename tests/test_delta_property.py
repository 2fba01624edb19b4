"""Randomised check of the snapshot delta against a brute-force model of its semantics."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cumulus.operators.delta import snapshot_delta

DATES = [dt.date(2026, 4, 28), dt.date(2026, 4, 30), dt.date(2026, 5, 1), dt.date(2026, 5, 2), dt.date(2026, 5, 5)]
OFFICES = ["A", " A", "A\t", "B", None]
MAKERS = ["M", "N", None]
value = st.one_of(st.none(), st.integers(min_value=-5, max_value=50))
row = st.tuples(st.sampled_from(DATES), st.sampled_from(OFFICES), st.sampled_from(MAKERS), value, value)


def model(rows):
    """Brute force: previous snapshot = previous date present in the same month; OLD missing -> 0."""
    norm = lambda s: None if s is None else s.strip()
    sums = defaultdict(lambda: [None, None])
    for d, office, maker, p, q in rows:
        acc = sums[(d, norm(office), maker)]
        for i, v in enumerate((p, q)):
            if v is not None:
                acc[i] = (acc[i] or 0) + v
    dates = sorted({r[0] for r in rows})
    prev = {}
    for i, d in enumerate(dates):
        earlier = [e for e in dates[:i] if (e.year, e.month) == (d.year, d.month)]
        prev[d] = earlier[-1] if earlier else None
    out = {}
    for (d, office, maker), (p, q) in sums.items():
        old = sums.get((prev[d], office, maker), [None, None]) if prev[d] else [None, None]
        out[(d, office, maker)] = ((p or 0) - (old[0] or 0), (q or 0) - (old[1] or 0))
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25))
def test_delta_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "snapshot_date date, RTO string, Maker string, PETROL bigint, DIESEL bigint")
    got = {(r.snapshot_date, r.RTO, r.Maker): (r.PETROL, r.DIESEL) for r in snapshot_delta(df, ["RTO", "Maker"]).collect()}
    assert got == model(rows)


pair_row = st.tuples(st.sampled_from(OFFICES), st.sampled_from(MAKERS), value)


def _sums(rows):
    norm = lambda s: None if s is None else s.strip()
    out = {}
    for office, maker, v in rows:
        k = (norm(office), maker)
        cur = out.get(k)
        out[k] = cur if v is None else (cur or 0) + v
        out.setdefault(k, None)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pair_row, max_size=12), st.lists(pair_row, min_size=1, max_size=12))
def test_delta_pair_matches_model(spark, old_rows, new_rows):
    from cumulus.operators.delta import delta_pair

    schema = "RTO string, Maker string, PETROL bigint"
    got = {(r.RTO, r.Maker): r.PETROL for r in delta_pair(spark.createDataFrame(old_rows, schema),
                                                           spark.createDataFrame(new_rows, schema), ["RTO", "Maker"]).collect()}
    new, old = _sums(new_rows), _sums(old_rows)
    assert got == {k: (v or 0) - (old.get(k) or 0) for k, v in new.items()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pair_row, max_size=12), st.lists(pair_row, max_size=12))
def test_reconcile_matches_model(spark, left_rows, right_rows):
    from cumulus.operators.reconcile import reconcile

    schema = "RTO string, Maker string, PETROL bigint"
    got = {(r.RTO, r.Maker): r.PETROL for r in reconcile(spark.createDataFrame(left_rows, schema),
                                                         spark.createDataFrame(right_rows, schema), ["PETROL"]).collect()}
    expect = {}
    for sign, rows_ in ((1, left_rows), (-1, right_rows)):
        for office, maker, v in rows_:
            expect[(office, maker)] = expect.get((office, maker), 0) + sign * (v or 0)
    assert got == expect
