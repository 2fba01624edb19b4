"""The daily run and the monthly correction as Spark jobs over stored tables.

A store is a folder on shared storage holding these tables:

* ``snapshots`` - wide month-to-date rows, partitioned by ``snapshot_date`` (data date);
* ``facts`` - increments, partitioned by ``snapshot_date`` and ``row_source``
  (``delta``; stores of earlier versions also hold ``filler`` rows there);
* ``ledger`` - correction rows by the month they correct and the run that made
  them (``operators/ledger.py``), so recomputing increments never touches them;
* ``mart`` - the long mart, partitioned by ``period`` (``yyyy-MM``);
* ``quarantine`` - report files set aside, partitioned by ``run_date``.

Every job overwrites only the partitions it computes (dynamic partition
overwrite), so running a day twice, a late day, or a retried job leaves the
same tables. Measures are whatever columns the snapshots hold: a fuel that
appears one day is a new column from then on and counts 0 before. Increments are recomputed for a whole month from its stored
snapshots: a late snapshot changes its own increment and the next one, both
inside the month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalars import fmt_day_first
from .functions.schema import DELTA_ID_COLUMNS, FUEL_COLUMNS, measure_columns, normalize_headers, q
from .operators import quality
from .operators.delta import snapshot_delta
from .operators.dims import FUEL_GROUPS, MAKER_SHORT, ZONE_BY_STATE
from .operators.ledger import Ledger, month_corrections, with_corrections
from .operators.mart import audited_mart, month_to_date
from .operators.reconcile import monthly_summary
from .session import materialize
from .sources.files import drop_partition, observed, partition_values, read_table, write_csv_export, write_table
from .sources.reports import consolidate_reports, read_report_rows

# Snapshot key. The source keys on (RTO, vehicle_type, Maker); one office name can
# carry two codes, so the default adds the office code. COMPAT_KEYS reproduces the source.
DEFAULT_KEYS = ["RTO", "rto_number", "vehicle_type", "Maker"]
COMPAT_KEYS = ["RTO", "vehicle_type", "Maker"]
ATTRIBUTES = ["state", "rto_number", "district"]
MEASURES = [*FUEL_COLUMNS, "TOTAL"]
FACT_IDS = ["scrape_timestamp", "timestamp", "state", "RTO", "rto_number", "vehicle_type", "district", "Maker"]
_STORED = ["snapshot_date", "row_source"]


@dataclass(frozen=True)
class Store:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def _month_range(month: dt.date):
    first = month.replace(day=1)
    nxt = (first + dt.timedelta(days=32)).replace(day=1)
    return first, nxt


def _dated(table: DataFrame, first: dt.date, nxt: dt.date) -> DataFrame:
    return table.where((F.col("snapshot_date") >= first) & (F.col("snapshot_date") < nxt))


def stored_measures(*tables: DataFrame) -> list[str]:
    """PRJ7: the measure columns of stored tables, in the order of their first appearance."""
    found = (c for t in tables for c in measure_columns(t, exclude=[*DELTA_ID_COLUMNS, *_STORED]))
    return list(dict.fromkeys(found))


def ledger(spark: SparkSession, store: Store) -> Ledger:
    return Ledger(spark, store.path("ledger"))


def read_facts(spark: SparkSession, store: Store, months: Sequence[dt.date] | None = None) -> DataFrame:
    """Increments with the corrections of their months; of ``months`` only those partitions are read."""
    facts, wanted = read_table(spark, store.path("facts")), None
    if months is not None:
        wanted = F.col("corrected_month").isin([_month_range(m)[0] for m in months])
        inside = F.lit(False)
        for first, nxt in map(_month_range, months):
            inside = inside | ((F.col("snapshot_date") >= first) & (F.col("snapshot_date") < nxt))
        facts = facts.where(inside)
    return with_corrections(facts.drop(*_STORED), ledger(spark, store), wanted).drop("row_source")


def check_inputs(spark: SparkSession, landing: str, manifest_path: str, ext: str = ".xlsx",
                 states: Mapping[str, str] | None = None, fail_on_missing: bool = False) -> dict[str, DataFrame]:
    """C10 + C11 on a landing folder: missing files, re-fetch targets, totals, header audit.

    ``ext`` is the report extension the manifest names use (``.csv`` for CSV exports).
    With ``fail_on_missing`` a day with missing files raises ``quality.MissingFilesError``.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select("path")
    present = listing.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"))
    expected = quality.read_manifest(spark, manifest_path)
    missing = quality.missing_files(expected, present, ext=ext)
    if fail_on_missing:
        quality.require_complete(missing)
    titles = read_report_rows(spark, landing, pattern="*").groupBy("path").agg(F.max("title").alias("title"))
    return {
        "missing": missing,
        "targets": quality.rescrape_targets(missing, states) if states else quality.rescrape_targets(missing),
        "totals": quality.completeness_totals(expected, present, missing, ext=ext),
        "headers": quality.header_audit(titles),
    }


def ingest_day(spark: SparkSession, store: Store, landing: str, run_date: dt.date, district: DataFrame | None = None,
               makers: DataFrame | None = None, fuels: Sequence[str] = MEASURES) -> dict[str, int]:
    """C1: the day's report files -> the day's snapshot partition (+ quarantine rows).

    Returns the row counts (AG7), observed while writing: no second pass.
    """
    rows = materialize(read_report_rows(spark, landing), "sheets")  # read by the measures and by the table
    wide, bad = consolidate_reports(rows, F.lit(run_date), district, makers, fuels=fuels)
    snap, snap_obs = observed(normalize_headers(wide).withColumn("snapshot_date", F.lit(run_date - dt.timedelta(days=1))), "snapshot")
    write_table(snap, store.path("snapshots"), partition_by=["snapshot_date"], sort_by=["RTO", "Maker"])
    bad, bad_obs = observed(bad.withColumn("run_date", F.lit(str(run_date))), "quarantine")
    write_table(bad, store.path("quarantine"), partition_by=["run_date"])
    if not bad_obs.get["rows"]:  # dynamic overwrite replaces no partition when there are no rows
        drop_partition(spark, store.path("quarantine"), f"run_date={run_date}")
    return {"snapshot_rows": snap_obs.get["rows"], "quarantined_files": bad_obs.get["rows"]}


def increments_for_month(spark: SparkSession, store: Store, month: dt.date, keys: Sequence[str] = DEFAULT_KEYS,
                         measures: Sequence[str] | None = None) -> int:
    """C2 + C3: recompute every increment of ``month`` from its snapshots; replace the month's delta rows.

    Returns the number of increment rows written (observed during the write).
    """
    snaps = _dated(read_table(spark, store.path("snapshots")), *_month_range(month))
    measures = list(measures) if measures else stored_measures(snaps)
    attrs = [a for a in ATTRIBUTES if a not in keys]
    delta = snapshot_delta(snaps, keys, measures, attributes=attrs)
    facts = delta.select(
        fmt_day_first(F.date_add("snapshot_date", 1)).alias("scrape_timestamp"),
        fmt_day_first(F.col("snapshot_date")).alias("timestamp"),
        *[F.col(q(c)) for c in (*FACT_IDS[2:], *measures)],
        "snapshot_date",
        F.lit("delta").alias("row_source"),
    )
    facts, obs = observed(facts, "increments")
    write_table(facts, store.path("facts"), partition_by=_STORED)
    return obs.get["rows"]


def correct_month(spark: SparkSession, store: Store, month: dt.date, run_date: dt.date, measures: Sequence[str] | None = None) -> int:
    """C7-C9: correction rows = month-end snapshot - the month's facts - what other runs have corrected.

    The rows go to the ledger under the month they correct and this run, with
    dates inside that month however late the run is. A second run on the same
    day replaces the first (a new version); one on a later day finds nothing
    left. Without any snapshot of the month nothing is written. Returns the
    number of correction rows.
    """
    first, nxt = _month_range(month)
    snaps = _dated(read_table(spark, store.path("snapshots")), first, nxt)
    facts = _dated(read_table(spark, store.path("facts")), first, nxt)
    last = max((d for d in partition_values(spark, store.path("snapshots"), "snapshot_date") if str(first) <= d < str(nxt)), default=None)
    if last is None:
        return 0
    measures = list(measures) if measures else stored_measures(snaps, facts)
    cum = snaps.where(F.col("snapshot_date") == F.lit(last).cast("date"))
    sums = [
        monthly_summary(side, measures=[m for m in measures if m in side.columns], date_col="snapshot_date", by_month=True)
        for side in (cum, facts)
    ]
    runs = spark.createDataFrame([(first, run_date)], "corrected_month date, run_date date")
    fill, obs = observed(month_corrections(*sums, ledger(spark, store), runs, measures, [*FACT_IDS, *measures]), "fillers")
    ledger(spark, store).append(fill, runs)
    return obs.get["rows"]


def build_outputs(spark: SparkSession, store: Store, office_dim: DataFrame, export: str | None = None,
                  fuel_groups: Mapping[str, Sequence[str]] = FUEL_GROUPS, maker_short: Mapping[str, str] = MAKER_SHORT,
                  zone_by_state: Mapping[str, str] = ZONE_BY_STATE, months: Sequence[dt.date] | None = None) -> DataFrame:
    """C4-C6: rebuild the mart's periods of ``months`` (None: all), return their audit row, export the latest month.

    Facts, corrections and the mart are read and rewritten by period: a daily
    run passes the one or two months it touched and reads nothing else.
    """
    facts = read_facts(spark, store, months)
    audit = audited_mart(spark, facts, office_dim, fuel_groups, maker_short, zone_by_state, store.path("mart"))
    for month in months or ():  # dynamic overwrite replaces no period that has no rows any more
        if f"{month:%Y-%m}" not in audit.periods:
            drop_partition(spark, store.path("mart"), f"period={month:%Y-%m}")
    if export:
        write_csv_export(latest_period(spark, store), export, partition_by=["period"])
    return audit.row


def latest_period(spark: SparkSession, store: Store) -> DataFrame:
    """C6 on the stored mart: its latest month, named by one folder listing, so that only that period is scanned."""
    periods = partition_values(spark, store.path("mart"), "period")
    if not periods:
        raise FileNotFoundError("the mart has no period")
    return month_to_date(spark.read.parquet(store.path("mart")).where(F.col("period") == periods[-1]))
