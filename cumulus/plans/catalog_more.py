"""Registered queries: dims, mart, reconciliation, master append, scalars, quality."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.schema import numeric_column_flags
from ..operators.dims import keep_listed, lookup, map_dim, unmapped
from ..operators.mart import audit_totals, build_mart, month_to_date
from ..operators.master import replace_and_append, write_run_partition
from ..operators.quality import (
    completeness_totals,
    header_audit,
    keep_last_per_target,
    missing_files,
    rescrape_targets,
    status_counts,
    targets_per_state,
    with_identity,
)
from ..operators.reconcile import apply_corrections, filler_rows, monthly_summary, reconcile
from ..operators.reshape import union_aligned
from ..session import materialize, scratch_path
from ..sources.reports import consolidate_reports
from ..sources.tables import Tables
from ..streaming.incremental import run_incremental
from . import domain as D
from . import fixtures as X
from .catalog import register
from .report_export import reports_fixture

# --- dimensions (JN4, JN5, JN7, DD2) --------------------------------------------


@register("dim_enrich")
def dim_enrich(spark: SparkSession, data_dir: str) -> DataFrame:
    """JN4: master rows with cluster/city/AO and maker short name; misses stay NULL."""
    t = Tables(spark, data_dir)
    m = X.master_facts(spark, data_dir)
    m = lookup(m, X.geo_dim(t), "RTO", ["cluster", "city", "AO"])
    m = lookup(m, map_dim(spark, X.MAKER_SHORT_T, "Maker", "maker_short"), "Maker", ["maker_short"])
    return m.select(
        S.parse_day_first(F.col("timestamp")).alias("Date"), "RTO", "vehicle_type", "Maker", "cluster", "city", "AO", "maker_short", "TOTAL"
    )


@register("dim_default_unknown")
def dim_default_unknown(spark: SparkSession, data_dir: str) -> DataFrame:
    """JN5: district looked up on the upper-cased office, default 'Unknown'; rows and volume per pair."""
    m = X.master_facts(spark, data_dir)
    return m.groupBy("RTO", "district").agg(F.count(F.lit(1)).alias("rows"), F.sum("TOTAL").alias("total"))


@register("dim_unmapped")
def dim_unmapped(spark: SparkSession, data_dir: str) -> DataFrame:
    """JN7 + DD2: distinct offices of the facts missing from the geography dimension."""
    t = Tables(spark, data_dir)
    m = X.master_facts(spark, data_dir)
    return unmapped(m, X.geo_dim(t), "RTO", "RTO").withColumnRenamed("value", "RTO")


# --- mart (C4, C5, C6, SC12-14) ---------------------------------------------------


def _mart(spark: SparkSession, data_dir: str) -> DataFrame:
    p = X.Derivation(spark, data_dir)
    return build_mart(spark, p.master(), X.geo_dim(p.t), X.FUEL_GROUPS_T, X.MAKER_SHORT_T, X.ZONE_T)


@register("fuel_group_mart")
def fuel_group_mart(spark: SparkSession, data_dir: str) -> DataFrame:
    """C4: long mart with fuel groups, dims, zone and fiscal calendar."""
    return _mart(spark, data_dir)


@register("fiscal_calendar")
def fiscal_calendar(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC12-14: financial year, quarter and month name of every order day."""
    t = Tables(spark, data_dir)
    d = F.col("day")
    days = t.orders.select(F.to_date("o_orderdate").alias("day")).where(d.isNotNull()).distinct()
    return days.select("day", S.fiscal_year(d).alias("FY"), S.fiscal_quarter(d).alias("Qtr"), S.month_name(d).alias("month"))


@register("mart_audit")
def mart_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    """C5: stage totals, unmapped fuel rows/volume, rows without AO, verdict."""
    t = Tables(spark, data_dir)
    return audit_totals(X.master_facts(spark, data_dir), X.geo_dim(t), X.FUEL_GROUPS_T)


@register("month_to_date")
def month_to_date_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """C6: mart rows from the 1st of the latest month to the latest date.

    The mart is written once to the shared checkpoint folder (the stored mart
    table), so the latest-date subquery scans it instead of rebuilding it.
    """
    return month_to_date(materialize(_mart(spark, data_dir)))


# --- reconciliation (C7, C8, C9) ------------------------------------------------------


@register("monthly_summary")
def monthly_summary_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """C7: month totals per (RTO, Maker, state, rto_number, district) for the month of the latest run.

    The month comes from the run calendar (one date column scanned, a scalar
    subquery), as the source takes the current month; the facts are read once.
    """
    p = X.Derivation(spark, data_dir)
    latest = D.run_calendar(p.t).select(F.max("day")).scalar()
    m = p.master()
    m = m.where(S.parse_day_first(F.col("timestamp")) >= F.trunc(latest, "month"))
    return monthly_summary(m, measures=D.MEASURES)


def _summaries(p: X.Derivation) -> tuple[DataFrame, DataFrame]:
    """(cumulative month-end summary, facts summary with the missed run), per month and key."""
    cum_s = monthly_summary(p.cumulative_month_end(), measures=D.MEASURES, by_month=True)
    facts_s = monthly_summary(p.master(missed_run=True), measures=D.MEASURES, by_month=True)
    return cum_s, facts_s


def _reconciled(p: X.Derivation, sums: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Per month and key: cumulative month-end figure minus the sum of increments (with a missed run)."""
    cum_s, facts_s = sums or _summaries(p)
    return reconcile(cum_s, facts_s, D.MEASURES, keys=("month", "RTO", "Maker"))


def _fillers(p: X.Derivation, sums: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    diff = _reconciled(p, sums).join(F.broadcast(p.month_end()), "month")  # one row per month
    return filler_rows(diff, X.MASTER_LAYOUT, F.date_add("last_day", 1), types={m: "bigint" for m in D.MEASURES})


@register("reconcile_full_outer")
def reconcile_full_outer(spark: SparkSession, data_dir: str) -> DataFrame:
    """C8: per month and key, cumulative month-end figure minus the sum of increments (missed run)."""
    return _reconciled(X.Derivation(spark, data_dir))


@register("filler_rows")
def filler_rows_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """C8 output: correction rows in the fixed wide layout, stamped with each month's run date."""
    return _fillers(X.Derivation(spark, data_dir))


@register("corrected_master")
def corrected_master(spark: SparkSession, data_dir: str) -> DataFrame:
    """C9: facts + correction rows; per month their sums equal the cumulative figures.

    The corrected table is ``apply_corrections(facts, fillers)``. Its monthly
    check uses that sums are additive: the facts are summarised once (the
    same summary feeds the correction rows), and the correction rows are
    added to that summary instead of re-aggregating every fact row.
    """
    p = X.Derivation(spark, data_dir)
    cum_s, facts_s = sums = _summaries(p)
    fillers_s = monthly_summary(_fillers(p, sums), measures=D.MEASURES, by_month=True)
    keys = ["month", "RTO", "Maker", "state", "rto_number", "district"]
    corrected = facts_s.unionByName(fillers_s).groupBy(*keys).agg(*[F.sum(F.col(f"`{m}`")).alias(m) for m in D.MEASURES])
    check = reconcile(cum_s, corrected, ["TOTAL"], keys=("month", "RTO", "Maker"))
    per_month = check.groupBy("month").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("TOTAL") != 0).alias("keys_unbalanced")
    )
    totals = corrected.groupBy("month").agg(F.sum("TOTAL").alias("corrected_total"))
    return per_month.join(totals, "month").select("month", "keys", "keys_unbalanced", "corrected_total")


@register("corrected_master_rows")
def corrected_master_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """C9 output: the fact table with the correction rows appended (master's column order first)."""
    p = X.Derivation(spark, data_dir)
    sums = _summaries(p)
    return apply_corrections(p.master(missed_run=True), _fillers(p, sums))


# --- master append (C3, UN1/UN2) --------------------------------------------------------


def _event_counts(events: DataFrame, day_col: str = "day") -> DataFrame:
    return events.groupBy(day_col, "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.round(F.col("value") * 100)).cast("bigint").alias("value_cents")
    )


def _run_stamp(day):
    """Run date of a data day (data date + 1) as ``dd-MM-yyyy`` text."""
    return S.fmt_day_first(F.date_add(day, 1))


def _with_run_date(df: DataFrame) -> DataFrame:
    """Replace ``day`` by the ``scrape_date`` partition value (run date, ``yyyy-MM-dd``)."""
    return df.withColumn("scrape_date", F.date_format(F.date_add("day", 1), "yyyy-MM-dd")).drop("day")


@register("replace_and_append")
def replace_and_append_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """C3 + FLT7: the latest day was loaded early (morning only); its replay replaces those rows."""
    t = Tables(spark, data_dir)
    ev = t.events.select(F.to_date("ts").alias("day"), "ts", "event_type", "value")
    last_day = ev.select(F.max("day")).scalar()
    earlier = _event_counts(ev.where(F.col("day") < last_day))
    morning = _event_counts(ev.where((F.col("day") == last_day) & (F.hour("ts") < 12)))
    master = earlier.unionByName(morning).select(_run_stamp(F.col("day")).alias("scrape_timestamp"), "event_type", "events", "value_cents")
    replay = _event_counts(ev.where(F.col("day") == last_day)).select(
        _run_stamp(F.col("day")).alias("scrape_timestamp"), "event_type", "events", "value_cents"
    )
    return replace_and_append(master, replay, F.date_add(last_day, 1))


@register("align_union")
def align_union(spark: SparkSession, data_dir: str) -> DataFrame:
    """UN1/UN2: union by name; master's column order first, the new batch's extra column after."""
    t = Tables(spark, data_dir)
    ev = t.events.select(F.to_date("ts").alias("day"), "event_type", "user_id")
    last_day = ev.select(F.max("day")).scalar()
    master = ev.where(F.col("day") < last_day).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("events"))
    new = ev.where(F.col("day") == last_day).groupBy("event_type", "day").agg(
        F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("events")
    )
    return union_aligned(master, new)


# --- scalar functions (SC1-SC11, PRJ6) ---------------------------------------------------


@register("numeric_coerce")
def numeric_coerce(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC10: every whitespace-separated token of every document, parsed leniently (per row, no shuffle).

    Each token is parsed once (``to_number``: NULL when not a number); count
    and truncated sum come from that one parsed list.
    """
    t = Tables(spark, data_dir)
    tokens = F.filter(F.split(F.col("text"), r"\s+"), lambda x: x != "")
    parsed = F.transform(tokens, lambda x: S.to_number(x))
    return t.documents.select(
        "doc_id",
        F.size(tokens).cast("bigint").alias("n_tokens"),
        F.size(F.filter(parsed, lambda v: v.isNotNull())).cast("bigint").alias("n_numeric"),
        F.aggregate(
            parsed, F.lit(0).cast("bigint"), lambda acc, v: acc + F.coalesce(v.try_cast("bigint"), F.lit(0).cast("bigint"))
        ).alias("numeric_sum"),
    )


@register("numeric_columns")
def numeric_columns_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """PRJ6: which columns of ``documents`` hold at least one parsable number (one aggregate)."""
    t = Tables(spark, data_dir)
    return numeric_column_flags(t.documents, exclude=[])


@register("mixed_dates")
def mixed_dates(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC11: order dates written in three layouts, parsed back day-first."""
    t = Tables(spark, data_dir)
    d = F.to_date("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "dd-MM-yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.date_format(d, "yyyy-MM-dd"))
        .otherwise(F.date_format(d, "d/M/yyyy"))
    )
    o = t.orders.select("o_orderkey", d.alias("order_date"), text.alias("date_text"))
    parsed = S.parse_day_first(F.col("date_text"))
    return o.select("o_orderkey", "date_text", parsed.alias("parsed"), (parsed == F.col("order_date")).alias("ok"))


def _odd_names(t: Tables) -> DataFrame:
    """Manifest names plus odd shapes: no vehicle type, lower case, a ``.csv`` report."""
    co = X.customer_offices(t)
    base = F.concat("office", F.lit(" - "), "code")
    return co.select(
        F.explode(
            F.array(
                F.concat(base, F.lit("_motor_car.xlsx")),
                F.concat(base, F.lit("_motor_cab.xlsx")),
                F.concat(base, F.lit(".xlsx")),
                F.lower(F.concat(base, F.lit("_motor_car.xlsx"))),
                F.concat(base, F.lit("_motor_car_extra.csv")),
            )
        ).alias("name")
    )


@register("file_name_parse")
def file_name_parse(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC1-SC2: report file name -> state, office, code, vehicle type (NULL when unparsable)."""
    t = Tables(spark, data_dir)
    p = S.parse_report_filename(F.col("name"))
    code = p["office_code"]
    state = S.state_from_code(code, X.STATE_BY_PREFIX_T, default="Unknown")
    return _odd_names(t).select(
        "name", F.when(p.isNotNull(), state).alias("state"), p["office"].alias("office"), code.alias("office_code"),
        p["vehicle_type"].alias("vehicle_type"),
    )


@register("file_identity")
def file_identity_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC3-SC6: (office code, vehicle type, normalised office) of every landed file."""
    t = Tables(spark, data_dir)
    return with_identity(X.landed_files(t).select("name")).select("name", "office_code", "vehicle_type", "office_norm")


@register("normalize_text")
def normalize_text_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC5: drop parenthesised parts, collapse whitespace, trim, lower-case (whole documents)."""
    t = Tables(spark, data_dir)
    return t.documents.select("doc_id", S.normalize_text(F.col("text")).alias("normalized"))


@register("title_to_office")
def title_to_office(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC7: report title -> office (prefix any case; trailing ', state (...)' removed)."""
    t = Tables(spark, data_dir)
    return X.landed_files(t).select("name", "title", S.office_from_title(F.col("title")).alias("office"))


def _audit(spark: SparkSession, data_dir: str) -> DataFrame:
    t = Tables(spark, data_dir)
    files = X.landed_files(t).select(F.concat(F.lit("/landing/"), F.col("name")).alias("path"), "title")
    return header_audit(files)


@register("header_name_audit")
def header_name_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    """C11 / SC9: ok / mismatch (with proposed name) / no_header per landed file."""
    return _audit(spark, data_dir)


@register("header_status_counts")
def header_status_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    """AG8: files per audit status."""
    return status_counts(_audit(spark, data_dir))


@register("keep_last_per_target")
def keep_last_per_target_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """WN2: one winner per target name, the last path in sorted order."""
    return keep_last_per_target(_audit(spark, data_dir))


# --- completeness (C10) --------------------------------------------------------------------


def _missing(spark: SparkSession, data_dir: str):
    t = Tables(spark, data_dir)
    expected = X.manifest(t)
    present = X.landed_files(t).select("name")
    return expected, present, missing_files(expected, present)


@register("missing_files")
def missing_files_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """JN6: manifest entries matched neither by exact name nor by (code, vehicle type)."""
    _, _, m = _missing(spark, data_dir)
    return m.select("pos", "name", "office_code", "vehicle_type")


@register("rescrape_targets")
def rescrape_targets_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """DD1: one re-fetch target per (code, vehicle type), first in manifest order, known states only."""
    _, _, m = _missing(spark, data_dir)
    return rescrape_targets(m, X.STATE_BY_PREFIX_T)


@register("missing_by_state")
def missing_by_state(spark: SparkSession, data_dir: str) -> DataFrame:
    """AG10: re-fetch targets per state."""
    _, _, m = _missing(spark, data_dir)
    return targets_per_state(rescrape_targets(m, X.STATE_BY_PREFIX_T))


@register("completeness_totals")
def completeness_totals_q(spark: SparkSession, data_dir: str) -> DataFrame:
    """AG9: expected / present / missing counts."""
    e, p, m = _missing(spark, data_dir)
    return completeness_totals(e, p, m)


@register("code_lookup")
def code_lookup(spark: SparkSession, data_dir: str) -> DataFrame:
    """JN8: find each re-fetch target's entry in the office list by code (TN1 never matches TN10).

    Re-aimed from a per-entry regex scan to an equi-join on the extracted code.
    """
    t = Tables(spark, data_dir)
    _, _, m = _missing(spark, data_dir)
    targets = rescrape_targets(m, X.STATE_BY_PREFIX_T)
    entries = X.customer_offices(t).select(F.concat("office", F.lit(" - "), "code").alias("entry"))
    entries = entries.withColumn("__code", S.extract_office_code(F.col("entry")))
    return targets.join(entries, targets.rto_code == entries["__code"]).select("rto_code", "vehicle_type", "entry")


# --- snapshot choice, filters (SNP3, LM1, FLT1, FLT2) -----------------------------------------


@register("latest_snapshot")
def latest_snapshot(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNP3 / SNP1 / LM1: newest dated file wins (mtime only without dated names); mixed order's newest two."""
    t = Tables(spark, data_dir)
    ev = t.events.select(F.to_date("ts").alias("day"), "ts", "event_type")
    dated = ev.groupBy("day").agg(F.max("ts").alias("mtime")).select(
        F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(".csv")).alias("name"), F.col("day").cast("timestamp").alias("name_ts"), "mtime"
    )
    undated = ev.groupBy("event_type").agg(F.max("ts").alias("mtime")).select(
        F.concat(F.lit("export_"), F.col("event_type"), F.lit(".csv")).alias("name"), F.lit(None).cast("timestamp").alias("name_ts"), "mtime"
    )
    files = dated.unionByName(undated)
    has_date = F.col("name_ts").isNotNull()
    # SNP3: dated names win; the newest by date, by mtime only when no name is dated.
    dated_first = files.orderBy(has_date.desc(), F.coalesce("name_ts", "mtime").desc(), F.col("name").desc()).limit(1)
    # SNP1: one ordering mixing name dates and mtimes; the newest two, ranked without a global window.
    mixed_key = F.coalesce(F.col("name_ts"), F.col("mtime"))
    newest = files.orderBy(mixed_key.desc(), F.col("name").desc()).limit(1)
    second = files.join(newest.select("name"), "name", "left_anti").orderBy(mixed_key.desc(), F.col("name").desc()).limit(1)
    return (
        dated_first.select(F.lit("dated_first").alias("rule"), F.lit(1).alias("rank"), "name")
        .unionByName(newest.select(F.lit("mixed").alias("rule"), F.lit(1).alias("rank"), "name"))
        .unionByName(second.select(F.lit("mixed").alias("rule"), F.lit(2).alias("rank"), "name"))
    )


@register("maker_whitelist")
def maker_whitelist(spark: SparkSession, data_dir: str) -> DataFrame:
    """FLT2: orders of whitelisted makers only (stripped, broadcast semi join); count per maker."""
    t = Tables(spark, data_dir)
    allowed = spark.createDataFrame([(m,) for m in X.MAKER_WHITELIST_T], "maker string")
    kept = keep_listed(D.order_facts(t), "maker", F.broadcast(allowed), "maker")
    return kept.groupBy("maker").agg(F.count(F.lit(1)).alias("orders"))


@register("drop_blank_rows")
def drop_blank_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """FLT1: every line of every document is a sheet row; drop blank lines and repeated 'Maker'/'TOTAL' rows."""
    t = Tables(spark, data_dir)
    lines = t.documents.select("doc_id", F.posexplode(F.split(F.col("text"), "\n")).alias("line_no", "line"))
    rows = lines.select("doc_id", "line_no", S.strip_ws(F.col("line")).alias("label"))
    return rows.where(F.col("label").isNotNull() & ~F.col("label").isin("Maker", "TOTAL", ""))



# --- report ingest (C1, SRC1-SRC3) --------------------------------------------------------------


def _ingest(spark: SparkSession, data_dir: str):
    t = Tables(spark, data_dir)
    cells = reports_fixture(spark, data_dir)
    makers = spark.createDataFrame([(m,) for m in X.MAKER_WHITELIST_T], "maker string")
    return consolidate_reports(cells, None, X.district_dim(t), makers, fuels=[*D.FUELS, "TOTAL"])


@register("ingest_reports")
def ingest_reports(spark: SparkSession, data_dir: str) -> DataFrame:
    """C1: month-end report matrices -> one wide snapshot row per run date, office, vehicle type, maker."""
    wide, _ = _ingest(spark, data_dir)
    return wide


@register("ingest_quarantine")
def ingest_quarantine(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC3: report files set aside (unparsable name or body), with the reason."""
    _, bad = _ingest(spark, data_dir)
    return bad.select(F.regexp_extract("path", r"([^/]*/[^/]*)$", 1).alias("file_name"), "error")


# --- X1: incremental (Structured Streaming) ----------------------------------------------------


@register("incremental_ingest")
def incremental_ingest(spark: SparkSession, data_dir: str) -> DataFrame:
    """X1: snapshots land in two waves (the 10th of each month arrives late); the stream's
    month-by-month recompute must equal the one-pass batch result."""
    t = Tables(spark, data_dir)
    snap = D.mtd_snapshots(t)
    root = scratch_path(spark, f"incremental-{uuid.uuid4().hex}")
    landing, master, ckpt = f"{root}/landing", f"{root}/master", f"{root}/_checkpoint"
    late = F.dayofmonth("snapshot_date") == 10
    snap.where(~late).repartition("month").write.partitionBy("month").parquet(landing)
    schema = spark.read.parquet(landing).schema
    run_incremental(spark, landing, master, ckpt, schema, D.KEYS, D.MEASURES, max_files_per_trigger=256)
    snap.where(late).repartition("month").write.mode("append").partitionBy("month").parquet(landing)
    run_incremental(spark, landing, master, ckpt, schema, D.KEYS, D.MEASURES, max_files_per_trigger=256)
    return spark.read.parquet(master).select("snapshot_date", *D.KEYS, *[F.col(f"`{m}`") for m in D.MEASURES])


@register("replace_partition_replay")
def replace_partition_replay(spark: SparkSession, data_dir: str) -> DataFrame:
    """C3 on storage: the fact table partitioned by run date; the last day, first loaded from a
    morning-only batch, is replayed twice with dynamic partition overwrite. Only its partition
    is rewritten, and the second replay changes nothing."""
    t = Tables(spark, data_dir)
    ev = t.events.select(F.to_date("ts").alias("day"), "ts", "event_type", "value")
    last_day = ev.select(F.max("day")).scalar()
    path = scratch_path(spark, f"facts-{uuid.uuid4().hex}")
    stale = _event_counts(ev.where((F.col("day") < last_day) | (F.hour("ts") < 12)))
    write_run_partition(spark, _with_run_date(stale), path)
    replay = _with_run_date(_event_counts(ev.where(F.col("day") == last_day)))
    write_run_partition(spark, replay, path)
    write_run_partition(spark, replay, path)
    return spark.read.parquet(path).select(F.col("scrape_date").cast("string").alias("scrape_date"), "event_type", "events", "value_cents")
