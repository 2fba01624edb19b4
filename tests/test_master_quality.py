"""Master append (C3), reconciliation helpers (C7-C9), completeness (C10), header audit (C11)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus.operators.master import drop_run, replace_and_append, write_run_partition
from cumulus.operators.quality import (
    MissingFilesError,
    header_audit,
    keep_last_per_target,
    missing_files,
    require_complete,
    rescrape_targets,
)
from cumulus.operators.reconcile import filler_rows, monthly_summary, reconcile
from cumulus.operators.reshape import union_aligned
from cumulus.session import scratch_path
from tests.conftest import rows

RUN_DATE = dt.date(2026, 5, 3)


def run_col():
    return F.lit(RUN_DATE)


def test_drop_run_keeps_unparsable_and_spares_fillers(spark):
    m = spark.createDataFrame(
        [("03-05-2026", 1, "delta"), ("03-05-2026", 2, "filler"), ("02-05-2026", 3, "delta"), ("garbage", 4, "delta"), (None, 5, None)],
        "scrape_timestamp string, v int, row_source string",
    )
    assert rows(drop_run(m, run_col()), "v") == [(3,), (4,), (5,)]
    assert rows(drop_run(m, run_col(), spare_col="row_source"), "v") == [(2,), (3,), (4,), (5,)]
    no_stamp = m.drop("scrape_timestamp")
    assert drop_run(no_stamp, run_col()).count() == 5


def test_replace_and_append_is_idempotent(spark):
    master = spark.createDataFrame([("02-05-2026", "a", 1), ("03-05-2026", "a", 9)], "scrape_timestamp string, k string, v int")
    new = spark.createDataFrame([("a", 2, "03-05-2026", "x")], "k string, v int, scrape_timestamp string, extra string")
    once = replace_and_append(master, new, run_col())
    twice = replace_and_append(once, new, run_col())
    assert once.columns == ["scrape_timestamp", "k", "v", "extra"]
    assert rows(once) == rows(twice)
    assert rows(once, "v") == [(1,), (2,)]


def test_union_aligned_order(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert union_aligned(a, b).columns == ["x", "y", "z"]


def test_partition_overwrite_replaces_only_the_run(spark):
    path = scratch_path(spark, f"master-test-{id(spark)}-{dt.datetime.now().timestamp()}")
    day = spark.createDataFrame([("2026-05-02", "a", 1), ("2026-05-03", "a", 5)], "scrape_date string, k string, v int")
    write_run_partition(spark, day, path)
    replay = spark.createDataFrame([("2026-05-03", "a", 7)], "scrape_date string, k string, v int")
    write_run_partition(spark, replay, path)
    write_run_partition(spark, replay, path)
    got = spark.read.parquet(path).select(F.col("scrape_date").cast("string").alias("scrape_date"), "v")
    assert rows(got, "scrape_date", "v") == [("2026-05-02", 1), ("2026-05-03", 7)]


def test_monthly_summary_reconcile_and_fillers(spark):
    cum = spark.createDataFrame(
        [("04-05-2026", "R1", "M", "KA1", 10), ("04-05-2026", "R2", "M", "KA2", 3), ("04-05-2026", None, "M", None, 1)],
        "timestamp string, RTO string, Maker string, rto_number string, PETROL bigint",
    )
    facts = spark.createDataFrame(
        [("02-05-2026", "R1", "M", "KA1", "4"), ("03-05-2026", "R1", "M", "KA1", "5"), ("03-05-2026", "R9", "M", "KA9", "2"),
         ("30-04-2026", "R1", "M", "KA1", "100"), ("bad", "R1", "M", "KA1", "100"), ("03-05-2026", None, "M", None, "1")],
        "timestamp string, RTO string, Maker string, rto_number string, PETROL string",
    )
    left = monthly_summary(cum, 5, 2026)
    right = monthly_summary(facts, 5, 2026)
    diff = {(r.RTO, r.rto_number): r.PETROL for r in reconcile(left, right, ["PETROL"]).collect()}
    assert diff == {("R1", "KA1"): 1, ("R2", "KA2"): 3, ("R9", "KA9"): -2, (None, None): 0}
    layout = ["scrape_timestamp", "timestamp", "RTO", "vehicle_type", "district", "Maker", "PETROL", "TOTAL"]
    fill = filler_rows(reconcile(left, right, ["PETROL"]), layout, F.lit(dt.date(2026, 5, 5)))
    r = fill.where(F.col("RTO") == "R1").first()
    assert (r.scrape_timestamp, r.timestamp, r.vehicle_type, r.district, r.TOTAL, r.row_source) == (
        "05-05-2026", "04-05-2026", "motor_car", None, None, "filler")
    assert fill.count() == 4  # all-zero rows are kept


def _names(spark, names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos int, name string")


def test_missing_files_exact_or_by_code(spark):
    expected = _names(spark, ["A - TN1_motor_car.xlsx", "A - TN1_motor_cab.xlsx", "B - TN10_motor_car.xlsx",
                              "C - KL2_motor_car.xlsx", "D - XX9_motor_car.xlsx"])
    present = spark.createDataFrame(
        [("a - tn1_MOTOR_CAR.XLSX",), ("B renamed - TN10_motor_car.xlsx",), ("C - KL2_motor_car.csv",), ("junk_other.xlsx",)], "name string"
    )
    miss = missing_files(expected, present)
    assert rows(miss, "name") == [("A - TN1_motor_cab.xlsx",), ("C - KL2_motor_car.xlsx",), ("D - XX9_motor_car.xlsx",)]
    tg = rescrape_targets(miss)
    assert rows(tg, "rto_code", "vehicle_type", "state") == [("KL2", "motor_car", "Kerala"), ("TN1", "motor_cab", "Tamil_Nadu")]


def test_files_without_code_or_known_type_are_matched_by_name_only(spark):
    expected = _names(spark, ["no code_motor_car.xlsx", "No code_motor_car.xlsx", "A - TN1_truck.xlsx", "A - TN1.xlsx", ".xlsx"])
    present = spark.createDataFrame([("NO CODE_motor_car.xlsx",), ("B - TN1_truck.xlsx",), ("C - TN1.xlsx",), ("other_motor_car.xlsx",)], "name string")
    assert rows(missing_files(expected, present), "name") == [(".xlsx",), ("A - TN1.xlsx",), ("A - TN1_truck.xlsx",)]


def test_fail_on_missing(spark):
    missing = _names(spark, ["c.xlsx", "b.xlsx", "a.xlsx"])
    require_complete(missing.limit(0))
    with pytest.raises(MissingFilesError) as raised:
        require_complete(missing, shown=2)
    assert raised.value.count == 3 and raised.value.names == ["c.xlsx", "b.xlsx"]
    assert "3 expected file(s) missing: c.xlsx, b.xlsx and 1 more" in str(raised.value)


def test_rescrape_dedup_first_in_manifest_order(spark):
    miss = spark.createDataFrame(
        [(5, "Y - KA99_motor_car.xlsx", "KA99", "motor_car"), (2, "X - KA99_motor_car.xlsx", "KA99", "motor_car")],
        "pos int, name string, office_code string, vehicle_type string",
    )
    assert rows(rescrape_targets(miss), "expected_filename") == [("X - KA99_motor_car.xlsx",)]


def test_header_audit_statuses_and_keep_last(spark):
    files = spark.createDataFrame(
        [("/d/ADOOR SRTO - KL26_motor_car.xlsx", "Maker Wise Fuel Data of ADOOR SRTO - KL26 , Kerala (2026)"),
         ("/d/3f2a_motor_car.xlsx", "Maker Wise Fuel Data of ADOOR SRTO - KL26 , Kerala (2026)"),
         ("/d/reporttable.xlsx", "maker wise fuel data of X - TN1 , Tamil Nadu"),
         ("/d/empty_motor_cab.xlsx", "")],
        "path string, title string",
    )
    a = {r.path: (r.status, r.new_path) for r in header_audit(files).collect()}
    assert a["/d/ADOOR SRTO - KL26_motor_car.xlsx"] == ("ok", None)
    assert a["/d/3f2a_motor_car.xlsx"] == ("mismatch", "/d/ADOOR SRTO - KL26_motor_car.xlsx")
    assert a["/d/reporttable.xlsx"] == ("mismatch", "/d/X - TN1_motor_car.xlsx")
    assert a["/d/empty_motor_cab.xlsx"][0] == "no_header"
    winners = {r.target: r.winner for r in keep_last_per_target(header_audit(files)).collect()}
    # the renamed file replaces the one that had the name
    assert winners["/d/ADOOR SRTO - KL26_motor_car.xlsx"] == "/d/3f2a_motor_car.xlsx"


def test_dimension_drift_gives_a_plus_minus_filler_pair(spark):
    # The office's district was remapped mid-month: the month-end snapshot carries the new
    # district, the earlier increments the old one, so the correction moves the volume.
    cum = spark.createDataFrame([("04-05-2026", "R1", "M", "New", 5)], "timestamp string, RTO string, Maker string, district string, PETROL bigint")
    facts = spark.createDataFrame(
        [("02-05-2026", "R1", "M", "Old", 3), ("03-05-2026", "R1", "M", "New", 2)],
        "timestamp string, RTO string, Maker string, district string, PETROL bigint",
    )
    diff = reconcile(monthly_summary(cum, 5, 2026), monthly_summary(facts, 5, 2026), ["PETROL"])
    assert rows(diff, "district", "PETROL") == [("New", 3), ("Old", -3)]


def test_bounded_broadcast_respects_the_session_bound(spark):
    from cumulus.operators.joins import BROADCAST_ROWS_CONF, bounded_broadcast

    small = spark.range(10)
    fact = spark.range(1000).withColumnRenamed("id", "k")

    def hinted(dim):
        plan = fact.join(dim, fact.k == dim.id)._jdf.queryExecution().optimizedPlan().toString()
        return "broadcast" in plan.lower()

    assert hinted(bounded_broadcast(small))
    spark.conf.set(BROADCAST_ROWS_CONF, "5")
    try:
        assert not hinted(bounded_broadcast(small))
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)
