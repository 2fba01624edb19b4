"""X1: incremental ingest survives a crash mid-batch and handles late snapshots."""

import datetime as dt

import pytest

from cumulus.operators.delta import snapshot_delta
from cumulus.streaming.incremental import affected_dates, batch_writer, run_incremental, touched_rows
from tests.conftest import rows

KEYS = ["RTO", "Maker"]
SCHEMA = "snapshot_date date, RTO string, Maker string, PETROL bigint, month date"


def snap_rows(days):
    out = []
    for d, vals in days.items():
        for (rto, maker), v in vals.items():
            out.append((d, rto, maker, v, d.replace(day=1)))
    return out


DAYS = {
    dt.date(2026, 4, 29): {("A", "M"): 3},
    dt.date(2026, 4, 30): {("A", "M"): 5, ("B", "M"): 1},
    dt.date(2026, 5, 1): {("A", "M"): 2},
    dt.date(2026, 5, 2): {("A", "M"): 4, ("B", "M"): 2},
    dt.date(2026, 5, 4): {("A", "M"): 7},
}
LATE = {dt.date(2026, 5, 3): {("A", "M"): 6, ("B", "M"): 2}}


def expected(spark, days):
    df = spark.createDataFrame(snap_rows(days), SCHEMA)
    return rows(snapshot_delta(df.drop("month"), KEYS, ["PETROL"]), "snapshot_date", "RTO", "Maker", "PETROL")


def test_crash_mid_batch_then_late_snapshot(spark, tmp_path):
    landing, master, ckpt = str(tmp_path / "landing"), str(tmp_path / "master"), str(tmp_path / "ckpt")
    spark.createDataFrame(snap_rows(DAYS), SCHEMA).repartition("month").write.partitionBy("month").parquet(landing)
    schema = spark.read.parquet(landing).schema

    # Attempt 1: the batch function writes its months, then the driver dies before the commit.
    write = batch_writer(spark, landing, master, schema, KEYS, ["PETROL"])

    def crash(batch, epoch_id):
        write(batch, epoch_id)
        raise RuntimeError("lost the driver")

    q = (spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(crash)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    with pytest.raises(Exception):
        q.awaitTermination()

    # Restart from the same checkpoint: the uncommitted batch is replayed; month overwrite makes it idempotent.
    run_incremental(spark, landing, master, ckpt, schema, KEYS, ["PETROL"])
    got = rows(spark.read.parquet(master), "snapshot_date", "RTO", "Maker", "PETROL")
    assert got == expected(spark, DAYS)

    # A late snapshot of May 3rd changes its own increment and May 4th's; no other date is rewritten.
    before = set(spark.read.parquet(master).inputFiles())
    spark.createDataFrame(snap_rows(LATE), SCHEMA).write.mode("append").partitionBy("month").parquet(landing)
    run_incremental(spark, landing, master, ckpt, schema, KEYS, ["PETROL"])
    got = rows(spark.read.parquet(master), "snapshot_date", "RTO", "Maker", "PETROL")
    assert got == expected(spark, {**DAYS, **LATE})
    after = set(spark.read.parquet(master).inputFiles())
    assert {f.rsplit("snapshot_date=", 1)[1][:10] for f in before ^ after} == {"2026-05-03", "2026-05-04"}
    may4 = [r for r in got if r[0] == dt.date(2026, 5, 4)]
    assert may4 == [(dt.date(2026, 5, 4), "A", "M", 1)]  # 7 - 6, not 7 - 4

    # Nothing new landed: a further run processes no batch and leaves the table as it is.
    run_incremental(spark, landing, master, ckpt, schema, KEYS, ["PETROL"])
    assert rows(spark.read.parquet(master), "snapshot_date", "RTO", "Maker", "PETROL") == got


def test_affected_dates_are_the_arrived_and_the_next():
    days = [dt.date(2026, 4, 30), *[dt.date(2026, 5, d) for d in (1, 2, 4, 7)]]
    got = affected_dates(days, [dt.date(2026, 5, 2), dt.date(2026, 4, 30)])
    assert got == {dt.date(2026, 4, 30): None, dt.date(2026, 5, 2): dt.date(2026, 5, 1), dt.date(2026, 5, 4): dt.date(2026, 5, 2)}
    assert affected_dates(days, []) == {}


def test_months_and_dates_reach_the_scan(spark, tmp_path):
    landing = str(tmp_path / "landing")
    spark.createDataFrame(snap_rows(DAYS), SCHEMA).write.partitionBy("month").parquet(landing)
    schema = spark.read.parquet(landing).schema
    plan = touched_rows(spark, landing, schema, [dt.date(2026, 5, 1)], dates=[dt.date(2026, 5, 4), None, dt.date(2026, 5, 2)])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text and "PushedFilters: [In(snapshot_date" in text
    assert {f.split("month=")[1][:10] for f in plan.inputFiles()} >= {"2026-05-01"} and plan.count() == 3
