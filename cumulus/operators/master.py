"""Idempotent daily append of increments to the fact table (C3, FLT7, UN1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_day_first
from .reshape import union_aligned


def drop_run(master: DataFrame, run_date: Column, stamp_col: str = "scrape_timestamp",
             spare_col: str | None = None, spare_values: tuple[str, ...] = ("filler",)) -> DataFrame:
    """FLT7: remove the rows a previous run of ``run_date`` wrote.

    Unparsable stamps are kept; a master without the stamp column is unchanged.
    With ``spare_col`` (e.g. ``row_source``) rows tagged with ``spare_values``
    survive, so correction rows are not lost to a same-day replay.
    """
    if stamp_col not in master.columns:
        return master
    stamp = master[stamp_col]
    d = stamp if dict(master.dtypes)[stamp_col] == "date" else parse_day_first(stamp)
    same_day = F.coalesce(d == run_date, F.lit(False))
    if spare_col and spare_col in master.columns:
        same_day = same_day & ~F.coalesce(master[spare_col].isin(*spare_values), F.lit(False))
    return master.where(~same_day)


def replace_and_append(master: DataFrame, increments: DataFrame, run_date: Column, stamp_col: str = "scrape_timestamp",
                       spare_col: str | None = None) -> DataFrame:
    """C3: drop the run's old rows, then union the new ones aligned by name (no shuffle)."""
    return union_aligned(drop_run(master, run_date, stamp_col, spare_col), increments)


def write_run_partition(spark: SparkSession, increments: DataFrame, path: str, partition_col: str = "scrape_date",
                        fmt: str = "parquet") -> None:
    """C3 on storage: overwrite only the partitions present in ``increments``.

    With ``partitionOverwriteMode=dynamic`` a replay of a day replaces that
    day's partition and nothing else; other days are never read or rewritten,
    and the job never overwrites a path its own input reads. The commit
    protocol makes the write atomic per task, so a lost executor's attempt is
    discarded and retried.
    """
    (
        increments.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .format(fmt)
        .save(path)
    )
