"""A hot key holding a third of all snapshot rows: right results, no single hot reducer."""

import datetime as dt

from pyspark.sql import functions as F

from cumulus.operators.delta import snapshot_delta


def test_hot_key_is_combined_and_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the 8 reduce partitions visible
    try:
        # 2 x 60 rows per day for cold keys, 60 duplicate rows per day for HOT: a third of all rows.
        grid = (
            spark.range(1)
            .select(F.explode(F.sequence(F.lit(0), F.lit(27))).alias("d"))
            .select("d", F.explode(F.sequence(F.lit(1), F.lit(60))).alias("r"))
            .select("d", F.explode(F.array(F.lit("COLD0"), F.lit("COLD1"), F.lit("HOT"))).alias("RTO"))
        )
        rows_ = grid.select(
            F.date_add(F.lit(dt.date(2026, 5, 1)), F.col("d")).alias("snapshot_date"), "RTO", (F.col("d") + 1).cast("bigint").alias("PETROL")
        )
        cold, hot = rows_.where("RTO <> 'HOT'"), rows_.where("RTO = 'HOT'")
        snaps = cold.unionByName(hot).repartition(8)
        assert hot.count() * 3 == snaps.count()
        out = snapshot_delta(snaps, ["RTO"], ["PETROL"]).withColumn("pid", F.spark_partition_id())
        got = {(r.snapshot_date.day, r.RTO): r.PETROL for r in out.collect()}
        # Each key's 60 rows per day carry the month-to-date value day + 1, so the summed increment is 60 a day.
        assert got[(1, "HOT")] == 60 and all(got[(d, "HOT")] == 60 for d in range(2, 29))
        assert got[(1, "COLD0")] == 60 and got[(5, "COLD1")] == 60
        hot_parts = [r.pid for r in out.where("RTO = 'HOT'").collect()]
        assert len(hot_parts) == 28 and len(set(hot_parts)) >= 4  # the hot key's days land on many reducers
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in plan  # duplicates are combined before the shuffle
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
