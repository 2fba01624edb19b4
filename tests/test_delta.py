"""Snapshot delta (C2): the traps of the source pipeline, one test each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus.operators.delta import delta_pair, snapshot_delta
from cumulus.operators.snapshots import latest_pair, snapshot_index
from tests.conftest import rows

KEYS = ["RTO", "vehicle_type", "Maker"]
SCHEMA = "snapshot_date date, RTO string, vehicle_type string, Maker string, PETROL bigint, DIESEL bigint"


def d(s):
    return dt.date.fromisoformat(s)


def snaps(spark, data):
    return spark.createDataFrame([(d(a), *rest) for a, *rest in data], SCHEMA)


def delta_map(df):
    return {(r.snapshot_date.isoformat(), r.RTO, r.vehicle_type, r.Maker): (r.PETROL, r.DIESEL) for r in df.collect()}


@pytest.fixture(scope="module")
def basic(spark):
    data = [
        ("2026-05-01", "A", "car", "M1", 5, 1),
        ("2026-05-02", "A", "car", "M1", 7, 1),
        ("2026-05-03", "A", "car", "M1", 6, 2),  # negative increment kept
        ("2026-05-02", "B", "car", "M1", 3, 0),  # B vanishes on 05-03, returns on 05-04
        ("2026-05-04", "B", "car", "M1", 4, 0),
        ("2026-05-04", "A", "car", "M1", 6, 2),
        ("2026-06-01", "A", "car", "M1", 2, 0),  # month reset: raw copy
    ]
    return delta_map(snapshot_delta(snaps(spark, data), KEYS))


def test_first_snapshot_of_month_is_raw(basic):
    assert basic[("2026-05-01", "A", "car", "M1")] == (5, 1)
    assert basic[("2026-06-01", "A", "car", "M1")] == (2, 0)


def test_increment_and_negative(basic):
    assert basic[("2026-05-02", "A", "car", "M1")] == (2, 0)
    assert basic[("2026-05-03", "A", "car", "M1")] == (-1, 1)


def test_vanished_key_dropped_and_returning_key_counts_old_as_zero(basic):
    assert ("2026-05-03", "B", "car", "M1") not in basic
    # OLD for 05-04 is the 05-03 snapshot, where B is absent: 4 - 0, not 4 - 3.
    assert basic[("2026-05-04", "B", "car", "M1")] == (4, 0)


def test_null_keys_match_and_whitespace_is_trimmed(spark):
    data = [
        ("2026-05-02", "OFFICE\t", "car", None, 3, 1),
        ("2026-05-03", " OFFICE", "car", None, 5, 1),
    ]
    out = delta_map(snapshot_delta(snaps(spark, data), KEYS))
    assert out[("2026-05-03", "OFFICE", "car", None)] == (2, 0)


def test_inner_double_spaces_are_significant(spark):
    data = [
        ("2026-05-02", "BAGALKOT  RTO", "car", "M", 3, 0),
        ("2026-05-03", "BAGALKOT RTO", "car", "M", 5, 0),
    ]
    out = delta_map(snapshot_delta(snaps(spark, data), KEYS))
    assert out[("2026-05-03", "BAGALKOT RTO", "car", "M")] == (5, 0)


def test_duplicate_keys_one_row_by_default_and_fan_out_in_compat(spark):
    data = [
        ("2026-05-02", "C", "car", "M", 1, 0),
        ("2026-05-03", "C", "car", "M", 1, 0),
        ("2026-05-03", "C", "car", "M", 2, 0),
    ]
    s = snaps(spark, data)
    one = snapshot_delta(s, KEYS).where(F.col("snapshot_date") == d("2026-05-03"))
    assert rows(one, "PETROL") == [(2,)]
    fan = snapshot_delta(s, KEYS, fan_out=True).where(F.col("snapshot_date") == d("2026-05-03"))
    assert rows(fan, "PETROL") == [(2,), (2,)]
    # On a snapshot without predecessor (the month's first) rows are copied one by one.
    first = snapshot_delta(snaps(spark, [("2026-05-02", "C", "car", "M", 1, 0), ("2026-05-02", "C", "car", "M", 4, 0)]), KEYS, fan_out=True)
    assert rows(first, "PETROL") == [(1,), (4,)]


def test_all_null_measure_counts_as_zero(spark):
    data = [
        ("2026-05-02", "A", "car", "M", 3, 1),
        ("2026-05-03", "A", "car", "M", None, 1),
    ]
    out = delta_map(snapshot_delta(snaps(spark, data), KEYS))
    assert out[("2026-05-03", "A", "car", "M")] == (-3, 0)


def test_gap_of_several_days_uses_previous_snapshot(spark):
    data = [
        ("2026-05-02", "A", "car", "M", 3, 0),
        ("2026-05-06", "A", "car", "M", 8, 0),
    ]
    out = delta_map(snapshot_delta(snaps(spark, data), KEYS))
    assert out[("2026-05-06", "A", "car", "M")] == (5, 0)


def test_string_measures_are_parsed_leniently(spark):
    df = spark.createDataFrame(
        [(d("2026-05-02"), "A", "car", "M", "3"), (d("2026-05-03"), "A", "car", "M", "5.9"),
         (d("2026-05-03"), "B", "car", "M", "1,234")],
        "snapshot_date date, RTO string, vehicle_type string, Maker string, PETROL string",
    )
    out = {(r.RTO): r.PETROL for r in snapshot_delta(df, KEYS).where(F.col("snapshot_date") == d("2026-05-03")).collect()}
    assert out["A"] == pytest.approx(2.9)
    assert out["B"] == 0  # '1,234' is not a number


def test_measure_columns_default_to_non_id_columns(spark):
    df = snaps(spark, [("2026-05-02", "A", "car", "M", 1, 2)]).withColumn("state", F.lit("X")).withColumn("rto_number", F.lit("KA1"))
    out = snapshot_delta(df, KEYS)
    assert set(out.columns) == {"snapshot_date", *KEYS, "PETROL", "DIESEL"}


def test_pair_new_only_measure_and_old_only_column(spark):
    new = spark.createDataFrame([("A", "car", "M", 5, 7)], "RTO string, vehicle_type string, Maker string, PETROL bigint, EV bigint")
    old = spark.createDataFrame([("A", "car", "M", 2, 9)], "RTO string, vehicle_type string, Maker string, PETROL bigint, LEGACY bigint")
    out = delta_pair(old, new, KEYS)
    assert out.columns == [*KEYS, "PETROL", "EV"]
    assert rows(out, "PETROL", "EV") == [(3, 7)]


def test_pair_without_old_is_raw_copy(spark):
    new = spark.createDataFrame([("A", "car", "M", 5)], "RTO string, vehicle_type string, Maker string, PETROL bigint")
    assert rows(delta_pair(None, new, KEYS), "PETROL") == [(5,)]


def test_snapshot_index_and_latest_pair(spark):
    s = snaps(spark, [("2026-04-30", "A", "c", "M", 1, 1), ("2026-05-01", "A", "c", "M", 1, 1), ("2026-05-03", "A", "c", "M", 1, 1)])
    idx = {r.snapshot_date.isoformat(): (r.prev_date, r.next_date) for r in snapshot_index(s).collect()}
    assert idx["2026-05-01"] == (None, d("2026-05-03"))
    assert idx["2026-04-30"] == (None, None)
    assert rows(latest_pair(s)) == [(d("2026-05-03"), d("2026-05-01"))]
    no_reset = {r.snapshot_date.isoformat(): r.prev_date for r in snapshot_index(s, reset=None).collect()}
    assert no_reset["2026-05-01"] == d("2026-04-30")


def test_office_code_as_key_separates_same_named_offices(spark):
    df = spark.createDataFrame(
        [(d("2026-05-02"), "STATE TRANSPORT AUTHORITY", "KA99", "car", "M", 1),
         (d("2026-05-02"), "STATE TRANSPORT AUTHORITY", "TN999", "car", "M", 5),
         (d("2026-05-03"), "STATE TRANSPORT AUTHORITY", "KA99", "car", "M", 2),
         (d("2026-05-03"), "STATE TRANSPORT AUTHORITY", "TN999", "car", "M", 5)],
        "snapshot_date date, RTO string, rto_number string, vehicle_type string, Maker string, PETROL bigint",
    )
    by_code = snapshot_delta(df, ["RTO", "rto_number", "vehicle_type", "Maker"]).where(F.col("snapshot_date") == d("2026-05-03"))
    assert rows(by_code, "rto_number", "PETROL") == [("KA99", 1), ("TN999", 0)]
    merged = snapshot_delta(df, KEYS, measures=["PETROL"]).where(F.col("snapshot_date") == d("2026-05-03"))
    assert rows(merged, "PETROL") == [(1,)]


def test_reporting_month_and_data_date(spark):
    from cumulus.functions.scalars import data_date, reporting_month

    df = spark.createDataFrame([(d("2026-01-01"),), (d("2026-05-02"),)], "run date")
    got = rows(df.select("run", data_date(F.col("run")).alias("dd"), reporting_month(F.col("run")).alias("m")))
    assert got == [(d("2026-01-01"), d("2025-12-31"), d("2025-12-01")), (d("2026-05-02"), d("2026-05-01"), d("2026-05-01"))]


def test_csv_null_tokens(spark):
    from cumulus.functions.schema import null_tokens_to_null

    df = spark.createDataFrame([("None", "NA", "x", " ")], "a string, b string, c string, e string")
    assert rows(null_tokens_to_null(df)) == [(None, None, "x", " ")]


def test_restrict_to_latest_pair(spark):
    from cumulus.operators.snapshots import restrict_to_latest_pair

    s = snaps(spark, [("2026-05-01", "A", "c", "M", 1, 1), ("2026-05-02", "A", "c", "M", 2, 1), ("2026-05-04", "A", "c", "M", 3, 1)])
    assert rows(restrict_to_latest_pair(s), "snapshot_date") == [(d("2026-05-02"),), (d("2026-05-04"),)]
    reset = snaps(spark, [("2026-04-30", "A", "c", "M", 1, 1), ("2026-05-01", "A", "c", "M", 2, 1)])
    assert rows(restrict_to_latest_pair(reset), "snapshot_date") == [(d("2026-05-01"),)]


def test_text_and_timestamp_snapshot_dates(spark):
    df = spark.createDataFrame(
        [("2026-05-02", "A", "M", 3), ("2026-05-03", "A", "M", 5)], "snapshot_date string, RTO string, Maker string, PETROL bigint"
    )
    assert rows(snapshot_delta(df, ["RTO", "Maker"]), "snapshot_date", "PETROL") == [(d("2026-05-02"), 3), (d("2026-05-03"), 2)]
    ts = df.withColumn("snapshot_date", F.to_timestamp("snapshot_date"))
    assert rows(snapshot_delta(ts, ["RTO", "Maker"]), "snapshot_date", "PETROL") == [(d("2026-05-02"), 3), (d("2026-05-03"), 2)]


def test_pair_fan_out_compat(spark):
    schema = "RTO string, vehicle_type string, Maker string, PETROL bigint"
    new = spark.createDataFrame([("C", "car", "M", 1), ("C", "car", "M", 2), ("D", "car", "M", 3)], schema)
    old = spark.createDataFrame([("C", "car", "M", 1)], schema)
    assert rows(delta_pair(old, new, KEYS, fan_out=True), "RTO", "PETROL") == [("C", 2), ("C", 2), ("D", 3)]
    assert rows(delta_pair(None, new, KEYS, fan_out=True), "RTO", "PETROL") == [("C", 1), ("C", 2), ("D", 3)]
