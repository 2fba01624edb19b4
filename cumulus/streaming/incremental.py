"""X1: incremental deltas as snapshot files land (Structured Streaming).

Snapshots land as files under a folder partitioned by ``month``. A file
stream with ``Trigger.AvailableNow`` picks up whatever arrived since the last
run (the checkpoint remembers which files were seen); ``foreachBatch`` then
recomputes only what the batch can change and overwrites those partitions of
the fact table, which is partitioned by snapshot date.

What changes: counters reset monthly and an increment is a snapshot minus the
one before it in its month, so a new, late or re-delivered snapshot of day *d*
changes the increments of *d* and of the next snapshot of that month, nothing
else (:func:`affected_dates`). Those need the snapshots of these dates and of
the one before each. The dates of the touched months come first, from the date
column alone; then months and dates go into the scan as literals, so other
months are pruned as partitions and other dates by the row group statistics.

Rewriting a partition is idempotent, so a batch replayed after an executor or
driver failure yields the same table. The checkpoint and the tables live under
the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.delta import snapshot_delta


def affected_dates(calendar: Iterable[dt.date], arrived: Iterable[dt.date]) -> dict[dt.date, dt.date | None]:
    """Dates whose increments the arrived snapshots change, each with the snapshot before it in its month (None: the first)."""
    arrived, found = set(arrived), {}
    days = sorted(calendar)
    for before, day in zip([None, *days], days):
        previous = before if before and (before.year, before.month) == (day.year, day.month) else None
        if day in arrived or previous in arrived:
            found[day] = previous
    return found


def batch_writer(
    spark: SparkSession,
    landing: str,
    master: str,
    schema: StructType,
    keys: Sequence[str],
    measures: Sequence[str],
    date_col: str = "snapshot_date",
):
    """The ``foreachBatch`` function: recompute and overwrite the dates that the batch changes."""

    def process(batch: DataFrame, epoch_id: int) -> None:
        # One row a date in the batch, one a date in the touched months: bounded by the calendar.
        arrived = batch.where(F.col(date_col).isNotNull()).select("month", date_col).distinct().collect()
        if not arrived:
            return
        store = touched_rows(spark, landing, schema, sorted({r["month"] for r in arrived}))
        calendar = [r[0] for r in store.where(F.col(date_col).isNotNull()).select(date_col).distinct().collect()]
        affected = affected_dates(calendar, [r[date_col] for r in arrived])
        rows = touched_rows(spark, landing, schema, sorted({r["month"] for r in arrived}), date_col, [*affected, *affected.values()])
        chain = [(day, before, None) for day, before in affected.items()]
        chain += [(before, None, day) for day, before in affected.items() if before and before not in affected]
        following = {before: day for day, before in affected.items() if before}
        index = spark.createDataFrame([(day, before, following.get(day)) for day, before, _ in chain], f"{date_col} date, prev_date date, next_date date")
        delta = snapshot_delta(rows, keys, measures, date_col=date_col, index=index, period_col="month", trim_keys=False)
        changed = delta.where(F.col(date_col).isin(list(affected)))
        parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Few dates: partitions by size, a large date over several. Many (a first load): dates side by side.
        changed = changed.repartition(parallel, date_col) if len(affected) > parallel else changed.hint("rebalance", date_col)
        (
            changed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(date_col)
            .parquet(master)
        )

    return process


def touched_rows(spark: SparkSession, landing: str, schema: StructType, months: Sequence[dt.date], date_col: str = "snapshot_date",
                 dates: Iterable[dt.date | None] | None = None) -> DataFrame:
    """Everything landed so far of these months, and of these dates if given; both are literals of the scan."""
    store = spark.read.schema(schema).parquet(landing).where(F.col("month").isin(list(months)))
    return store if dates is None else store.where(F.col(date_col).isin(sorted({d for d in dates if d})))


def run_incremental(
    spark: SparkSession,
    landing: str,
    master: str,
    checkpoint: str,
    schema: StructType,
    keys: Sequence[str],
    measures: Sequence[str],
    date_col: str = "snapshot_date",
    max_files_per_trigger: int = 32,
) -> None:
    """Process every snapshot file that landed since the last run, then stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)
    query = (
        stream.writeStream.foreachBatch(batch_writer(spark, landing, master, schema, keys, measures, date_col))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(query.exception()))
