"""Snapshot selection: ordering snapshots, predecessor per snapshot, latest ones.

A *snapshot* table holds one wide row per key per ``snapshot_date`` with
month-to-date counters. "Previous" always means the previous *snapshot* (the
previous date present in the table), never the previous row of a key: a key
missing from yesterday's snapshot has an old value of 0, so a per-key ``lag``
would subtract a stale value for a key that vanished and came back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Reset modes for the predecessor chain.
RESET_MONTH = "month"  # counters restart on the 1st: first snapshot of a month has no OLD
RESET_NONE = None  # one chain over all snapshots


def snapshot_index(snapshots: DataFrame, date_col: str = "snapshot_date", reset: str | None = RESET_MONTH) -> DataFrame:
    """One row per snapshot date: ``(date_col, prev_date, next_date, period)``.

    The index is the distinct dates, so it is bounded by the calendar (one row
    per day of history) whatever the size of the snapshots.
    """
    dates = snapshots.select(F.col(date_col).cast("date").alias(date_col)).where(F.col(date_col).isNotNull()).distinct()
    if reset == RESET_MONTH:
        dates = dates.withColumn("period", F.trunc(date_col, "month"))
        w = Window.partitionBy("period").orderBy(date_col)
    elif reset is None:
        # All dates in one ordered chain; the frame is one row per date.
        dates = dates.withColumn("period", F.lit(None).cast("date"))
        w = Window.partitionBy("period").orderBy(date_col)
    else:
        raise ValueError(f"unknown reset mode: {reset!r}")
    return dates.select(
        date_col,
        F.lag(date_col).over(w).alias("prev_date"),
        F.lead(date_col).over(w).alias("next_date"),
        "period",
    )


def latest_pair(snapshots: DataFrame, date_col: str = "snapshot_date", reset: str | None = RESET_MONTH) -> DataFrame:
    """``(new_date, old_date)`` for the latest snapshot; ``old_date`` is NULL on a reset.

    Like choosing the two newest daily files, but the month reset follows the
    data date, not the wall clock of the run.
    """
    idx = snapshot_index(snapshots, date_col, reset)
    return idx.orderBy(F.col(date_col).desc()).limit(1).select(
        F.col(date_col).alias("new_date"), F.col("prev_date").alias("old_date")
    )


def restrict_to_latest_pair(snapshots: DataFrame, date_col: str = "snapshot_date", reset: str | None = RESET_MONTH) -> DataFrame:
    """Keep only the rows of the latest snapshot and of its predecessor.

    The pair is one row, joined by broadcast; with ``date_col`` as a partition
    column of the source, dynamic partition pruning skips every other date.
    """
    pair = latest_pair(snapshots, date_col, reset)
    wanted = pair.select(F.explode(F.array("new_date", "old_date")).alias(date_col)).where(F.col(date_col).isNotNull())
    return snapshots.join(F.broadcast(wanted), on=date_col, how="left_semi")


def latest_by(df: DataFrame, order_cols: list, partition_cols: list | None = None) -> DataFrame:
    """Keep the first row per group under a total order (``row_number() == 1``).

    Without groups this is a top-1 (``orderBy().limit(1)``, a TakeOrdered),
    never a window over one global partition.
    """
    if not partition_cols:
        return df.orderBy(*order_cols).limit(1)
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def require_snapshots(snapshots: DataFrame, date_col: str = "snapshot_date") -> None:
    """SNP4: fail when there is no snapshot at all (a one-row probe, not a count)."""
    if not snapshots.where(F.col(date_col).isNotNull()).select(date_col).limit(1).collect():
        raise FileNotFoundError("no snapshot found")
