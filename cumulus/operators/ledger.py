"""Correction ledger (C9): corrections kept by the month they correct and the run that made them.

A correction belongs to the month it corrects, not to the month of the run:
May corrected on the 3rd and the 10th of June is two runs of May, and June has
none. The ledger is a folder of two append-only tables:

* ``rows`` - correction rows in the wide layout, partitioned by
  ``corrected_month``, ``run_date`` and ``version``;
* ``commits`` - one row for each (month, run) an append covers: ``seq``,
  ``version`` and the number of rows, also when that is 0.

An append writes its rows under a fresh version first and commits them after,
so a job that dies in between leaves rows nobody reads, and nothing is ever
overwritten that a running job may read. A run done again gets a new version;
readers take the latest one of every (month, run). The commits are one row a
month and run; readers resolve them first and push the versions into the scan
as partition filters.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import q
from ..sources.files import read_table, table_exists
from .reconcile import filler_rows, monthly_summary, reconcile

COMMIT_SCHEMA = "corrected_month date, run_date date, seq long, version string, n_rows long"
MAX_LITERAL_RUNS = 2000  # months and runs up to which versions are pushed as literals; beyond it a plain semi join
SUMMARY_KEYS = ("month", "RTO", "Maker")
SUMMARY_EXTRAS = ("state", "rto_number", "district")


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> DataFrame:
        if not table_exists(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.path}/commits")

    def latest(self) -> DataFrame:
        """``corrected_month, run_date, seq, version, n_rows``: the last commit of every month and run."""
        last = F.max_by(F.struct("seq", "version", "n_rows"), "seq").alias("last")
        return self.commits().groupBy("corrected_month", "run_date").agg(last).select("corrected_month", "run_date", "last.*")

    def read(self, runs: Column | None = None) -> DataFrame | None:
        """Correction rows of the latest versions; ``runs`` is a condition on ``corrected_month`` and ``run_date``.

        None when no version has a row. Measures that a version lacks are null.
        """
        latest = self.latest().where("n_rows > 0")
        latest = latest if runs is None else latest.where(runs)
        pairs = latest.select("corrected_month", "run_date", "version")
        known = pairs.limit(MAX_LITERAL_RUNS + 1).collect()
        if not known:
            return None
        rows = read_table(self.spark, f"{self.path}/rows")
        rows = rows.withColumns({c: F.col(c).cast("date") for c in ("corrected_month", "run_date")})
        if len(known) <= MAX_LITERAL_RUNS:
            rows = rows.where(F.col("version").isin(sorted({r.version for r in known})))
            pairs = F.broadcast(self.spark.createDataFrame(known, pairs.schema))
        # A version may cover months or runs whose latest version is another one.
        return rows.join(pairs, ["corrected_month", "run_date", "version"], "left_semi")

    def append(self, rows: DataFrame, runs: DataFrame) -> None:
        """Write ``rows`` (with ``corrected_month`` and ``run_date``) as a new version of every month and run of ``runs``."""
        version = uuid.uuid4().hex
        # One file for a month and run unless it is large: without this every task would write into every month.
        stamped = rows.withColumn("version", F.lit(version)).hint("rebalance", "corrected_month", "run_date")
        stamped.write.mode("append").partitionBy("corrected_month", "run_date", "version").parquet(f"{self.path}/rows")
        seq = (self.commits().agg(F.max("seq")).first()[0] or 0) + 1
        written = self.spark.read.schema(stamped.schema).parquet(f"{self.path}/rows").where(F.col("version") == version)
        counts = written.groupBy(F.col("corrected_month").cast("date"), F.col("run_date").cast("date")).agg(F.count(F.lit(1)).alias("n"))
        counts = counts.toDF("corrected_month", "run_date", "n")
        commit = runs.select("corrected_month", "run_date").distinct().join(counts, ["corrected_month", "run_date"], "left")
        commit.select(
            "corrected_month", "run_date", F.lit(seq).cast("long").alias("seq"), F.lit(version).alias("version"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"),
        ).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")


def other_corrections(ledger: Ledger, runs: DataFrame, measures: Sequence[str]) -> DataFrame | None:
    """Sums by month and key of what all runs but those of ``runs`` (one for each month) have corrected so far."""
    months = [r[0] for r in runs.select("corrected_month").distinct().collect()]  # one a month
    rows = ledger.read(F.col("corrected_month").isin(months))
    if rows is None:
        return None
    own = runs.select(F.col("corrected_month").alias("__m"), F.col("run_date").alias("__r"))
    rows = rows.join(own, (F.col("corrected_month") == F.col("__m")) & (F.col("run_date") == F.col("__r")), "left_anti")
    present = [m for m in measures if m in rows.columns]
    return monthly_summary(rows, measures=present, date_col="corrected_month", by_month=True)


def month_corrections(
    cumulative: DataFrame, facts: DataFrame, ledger: Ledger, runs: DataFrame, measures: Sequence[str], layout: Sequence[str]
) -> DataFrame:
    """C7-C9 for every month of ``runs(corrected_month, run_date)``: month-end figure minus facts minus earlier corrections.

    ``cumulative`` and ``facts`` are summaries by month (:func:`monthly_summary`
    with ``by_month``). One row for each month and key, all-zero ones kept, in
    the wide layout; ``timestamp`` is the day before the run, but never later
    than the corrected month's last day, so that the row stays in its month.
    """
    earlier = other_corrections(ledger, runs, measures)
    booked = facts if earlier is None else facts.unionByName(earlier, allowMissingColumns=True)
    days = runs.select(F.col("corrected_month").alias("month"), "run_date")
    diff = reconcile(cumulative, booked, measures, keys=SUMMARY_KEYS, extra_keys=SUMMARY_EXTRAS).join(days, "month")
    stamp = F.least(F.date_sub("run_date", 1), F.last_day("month"))
    rows = filler_rows(
        diff, [*layout, "month", "run_date"], F.col("run_date"), types={m: "bigint" for m in measures}, data_date=stamp
    )
    return rows.withColumnRenamed("month", "corrected_month")


def with_corrections(facts: DataFrame, ledger: Ledger, months: Column | None = None) -> DataFrame:
    """UN2: facts and the ledger's latest rows, each in the month it belongs to; columns aligned by name."""
    rows = ledger.read(months)
    if rows is None:
        return facts
    rows = rows.select([F.col(q(c)) for c in rows.columns if c not in ("corrected_month", "run_date", "version")])
    return facts.unionByName(rows, allowMissingColumns=True)
