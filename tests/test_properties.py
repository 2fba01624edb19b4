"""Properties of the composite operators on the smallest driver tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E


def q(spark, small_dir, name):
    return E.queries()[name](spark, small_dir)


def test_round_trip_increments_equal_daily_counts(spark, small_dir):
    """cumulative(month-to-date of daily counts) -> delta == the daily counts."""
    delta = q(spark, small_dir, "delta_all_snapshots")
    daily = q(spark, small_dir, "pivot_snapshot")
    nonzero = delta.where(F.col("TOTAL") != 0).select("snapshot_date", "office", "vehicle_type", "maker", "1-URGENT", "5-LOW")
    expect = daily.select(F.col("day").alias("snapshot_date"), "office", "vehicle_type", "maker", "1-URGENT", "5-LOW")
    assert nonzero.exceptAll(expect).count() == 0
    assert expect.exceptAll(nonzero).count() == 0
    assert delta.where(F.col("TOTAL") < 0).count() == 0
    orders = spark.read.parquet(f"{small_dir}/orders.parquet").count()
    assert delta.agg(F.sum("TOTAL")).first()[0] == orders


def test_month_reset_rows_equal_snapshot(spark, small_dir):
    out = q(spark, small_dir, "delta_month_reset").collect()
    assert out and all(r.delta_total == r.snapshot_total for r in out)


def test_reconciliation_balances_and_is_idempotent(spark, small_dir):
    fixed = q(spark, small_dir, "corrected_master").collect()
    assert fixed and all(r.keys_unbalanced == 0 for r in fixed)
    recon = q(spark, small_dir, "reconcile_full_outer")
    # Only the missed run (vehicle type P on the 15th) needs correction rows with volume.
    nonzero = recon.where(F.col("TOTAL") != 0)
    assert nonzero.where(F.col("TOTAL") < 0).count() == 0


def test_audit_identity(spark, small_dir):
    a = q(spark, small_dir, "mart_audit").first()
    assert a.initial_total == a.final_total + a.unmapped_fuel_volume
    mart_total = q(spark, small_dir, "fuel_group_mart").agg(F.sum("Regn Vol")).first()[0]
    assert mart_total == a.final_total
    assert a.verdict == ("preserved" if a.unmapped_fuel_volume == 0 else "loss")


def test_month_to_date_is_latest_month(spark, small_dir):
    mtd = q(spark, small_dir, "month_to_date")
    mart = q(spark, small_dir, "fuel_group_mart")
    latest = mart.agg(F.max("Date")).first()[0]
    got = mtd.agg(F.min("Date"), F.max("Date")).first()
    assert got[1] == latest and got[0] >= latest.replace(day=1)


def test_replace_and_append_replaces_the_stale_day(spark, small_dir):
    out = q(spark, small_dir, "replace_and_append")
    ev = spark.read.parquet(f"{small_dir}/events.parquet")
    assert out.agg(F.sum("events")).first()[0] == ev.count()
    assert out.groupBy("scrape_timestamp", "event_type").count().where("count > 1").count() == 0


def test_completeness_counts_add_up(spark, small_dir):
    t = q(spark, small_dir, "completeness_totals").first()
    assert t.missing == q(spark, small_dir, "missing_files").count()
    assert t.expected >= t.missing
    counts = {r.status: r.files for r in q(spark, small_dir, "header_status_counts").collect()}
    assert sum(counts.values()) == t.present + q(spark, small_dir, "header_name_audit").where(
        ~F.lower("path").endswith(".xlsx")
    ).count()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["snapshot_date", "office", "vehicle_type", "maker"]
    assert df.count() > 0
