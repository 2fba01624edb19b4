"""Registered queries over stored tables and files: ledger, open measures, drifting headers, measured audit, periods."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import parse_day_first, parse_mixed_dates
from ..operators.ledger import Ledger, month_corrections, with_corrections
from ..operators.mart import audited_mart, build_mart, month_to_date
from ..operators.reconcile import monthly_summary
from ..session import materialize, scratch_path
from ..sources.files import newest_files, partition_values, read_snapshot_csv, read_table, snapshot_files, write_table
from ..sources.reports import consolidate_reports
from . import domain as D
from . import fixtures as X
from .catalog import register
from .report_export import EXTRA_FUEL, reports_fixture, write_named_files

LATE_DAYS = (3, 10)  # days of the next month on which every month is corrected


def _fresh(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _corrected_store(spark: SparkSession, data_dir: str) -> tuple[X.Derivation, DataFrame, DataFrame, Ledger]:
    """(derivation, cumulative and facts summaries, ledger) after three late runs: the 3rd, the 10th, the 3rd again."""
    p = X.Derivation(spark, data_dir)
    cumulative = materialize(monthly_summary(p.cumulative_month_end(), measures=D.MEASURES, by_month=True), "cumulative")
    facts = materialize(monthly_summary(p.master(missed_run=True), measures=D.MEASURES, by_month=True), "facts")
    ledger = Ledger(spark, _fresh(spark, "ledger"))
    months = materialize(p.month_end().select(F.col("month").alias("corrected_month")), "months")
    for day in (*LATE_DAYS, LATE_DAYS[0]):
        runs = months.withColumn("run_date", F.date_add(F.add_months("corrected_month", 1), day - 1))
        ledger.append(month_corrections(cumulative, facts, ledger, runs, D.MEASURES, X.MASTER_LAYOUT), runs)
    return p, cumulative, facts, ledger


@register("correction_ledger")
def correction_ledger(spark: SparkSession, data_dir: str) -> DataFrame:
    """C9: every month corrected on two days of the next month, the first run replayed; what each run booked, by month and run."""
    ledger = _corrected_store(spark, data_dir)[-1]
    rows = ledger.read()
    changed = F.lit(False)
    for m in D.MEASURES:
        changed = changed | (F.col(f"`{m}`") != 0)
    inside = F.trunc(parse_day_first(F.col("timestamp")), "month") == F.col("corrected_month")
    versions = ledger.commits().groupBy("corrected_month", "run_date").agg(F.count(F.lit(1)).alias("versions"))
    booked = rows.groupBy("corrected_month", "run_date").agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(changed).alias("keys_changed"),
        F.sum("TOTAL").alias("corrected_total"),
        F.count_if(~inside).alias("rows_outside_month"),
    )
    return booked.join(versions, ["corrected_month", "run_date"])


@register("ledger_balance")
def ledger_balance(spark: SparkSession, data_dir: str) -> DataFrame:
    """C9: facts with the ledger's rows, summed by the month of their dates, against the month-end figures; no month is left open."""
    p, cumulative, _, ledger = _corrected_store(spark, data_dir)
    corrected = with_corrections(p.master(missed_run=True), ledger).drop("row_source")
    booked = monthly_summary(corrected, measures=["TOTAL"], by_month=True).select("month", F.col("TOTAL").alias("booked"), F.lit(0).alias("figure"))
    figures = cumulative.select("month", F.lit(0).alias("booked"), F.col("TOTAL").alias("figure"))
    return booked.unionByName(figures).groupBy("month").agg(F.sum("booked").alias("booked"), F.sum("figure").alias("figure"))


@register("ingest_open_measures")
def ingest_open_measures(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC2, C1, PRJ7: reports of odd run months hold a sixth fuel; it is a column of the stored table and a group of the mart.

    Two loads: even run months first, whose files and columns have no sixth
    fuel, then odd ones. The stored table is read with the columns of all its files.
    """
    rows = reports_fixture(spark, data_dir, extra=True)
    odd = F.regexp_extract("path", r"/\d{4}-(\d{2})-\d{2}_", 1).cast("int") % 2 == 1
    path = _fresh(spark, "open-snapshots")
    makers = spark.createDataFrame([(m,) for m in X.MAKER_WHITELIST_T], "maker string")
    for part in (rows.where(~odd), rows.where(odd)):
        wide, _ = consolidate_reports(part, None, X.district_dim(X.Tables(spark, data_dir)), makers, fuels=["TOTAL"])
        wide = wide.withColumn("period", F.date_format(parse_day_first(F.col("timestamp")), "yyyy-MM"))
        write_table(wide.withColumnRenamed("rto", "RTO"), path, partition_by=["period"])
    stored = read_table(spark, path).drop("period")
    groups = {**X.FUEL_GROUPS_T, "Trial": [EXTRA_FUEL]}
    mart = build_mart(spark, stored, X.geo_dim(X.Tables(spark, data_dir)), groups, X.MAKER_SHORT_T, X.ZONE_T)
    return mart.groupBy("Date", "FuelGroup").agg(F.count(F.lit(1)).alias("rows"), F.sum("Regn Vol").alias("volume"))


@register("mart_audit_measured")
def mart_audit_measured(spark: SparkSession, data_dir: str) -> DataFrame:
    """C5, AG4: totals observed at four stages of the plan that writes the mart, and of the stored mart.

    Three runs: all fuels mapped, the usual groups (one fuel is unmapped: loss),
    and an office that the geography dimension holds twice (gain).
    """
    p = X.Derivation(spark, data_dir)
    facts, dim = materialize(p.master(), "facts"), X.geo_dim(p.t)
    every = {**X.FUEL_GROUPS_T, "Other": ["4-NOT SPECIFIED"]}
    twice = dim.unionByName(dim.where(F.col("RTO") == dim.select(F.min("RTO")).scalar()))
    out = None
    for case, groups, offices in (("all_mapped", every, dim), ("unmapped_fuel", X.FUEL_GROUPS_T, dim), ("office_twice", every, twice)):
        audit = audited_mart(spark, facts, offices, groups, X.MAKER_SHORT_T, X.ZONE_T, _fresh(spark, "mart"))
        row = audit.row.select(F.lit(case).alias("case"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@register("mart_period_refresh")
def mart_period_refresh(spark: SparkSession, data_dir: str) -> DataFrame:
    """C6, FLT6: the stored mart's latest two periods rebuilt from their facts alone, then the month to date from the latest."""
    p = X.Derivation(spark, data_dir)
    facts = _fresh(spark, "facts")
    day = parse_day_first(F.col("timestamp"))
    write_table(p.master().withColumn("period", F.date_format(day, "yyyy-MM")), facts, partition_by=["period"])
    mart, dim = _fresh(spark, "mart"), X.geo_dim(p.t)
    stored = spark.read.parquet(facts)
    args = (dim, X.FUEL_GROUPS_T, X.MAKER_SHORT_T, X.ZONE_T, mart)
    audited_mart(spark, stored.where(day < stored.select(F.max(day)).scalar()).drop("period"), *args)
    touched = partition_values(spark, facts, "period")[-2:]
    audited_mart(spark, stored.where(F.col("period").isin(touched)).drop("period"), *args)
    latest = partition_values(spark, mart, "period")[-1]
    return month_to_date(spark.read.parquet(mart).where(F.col("period") == latest)).drop("period")


@register("snapshot_csv_drift")
def snapshot_csv_drift(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC4: snapshots as CSV files of three headers (usual; other order and spellings; one column less and one more)."""
    p = X.Derivation(spark, data_dir)
    wide = p.snap.select(
        F.date_format("snapshot_date", "dd-MM-yyyy").alias("timestamp"), F.col("office").alias("RTO"), "vehicle_type",
        F.col("maker").alias("Maker"), *[F.col(f"`{m}`") for m in D.MEASURES], (F.month("snapshot_date") % 3).alias("layout"),
    )
    wide = materialize(wide, "wide")
    root = _fresh(spark, "drift")
    fuels = [F.col(f"`{m}`") for m in D.MEASURES]
    layouts = [
        ["timestamp", "RTO", "vehicle_type", "Maker", *fuels],
        [F.col("Maker").alias(" OEM"), F.col("RTO").alias("rto"), F.col("vehicle_type").alias("Vehicle Type"), *fuels[::-1], "timestamp"],
        ["timestamp", "RTO", "vehicle_type", "Maker", *[f for f, m in zip(fuels, D.MEASURES) if m != "5-LOW"], F.col("2-HIGH").alias(EXTRA_FUEL)],
    ]
    folders = [f"{root}/{k}" for k in range(len(layouts))]
    for k, (columns, folder) in enumerate(zip(layouts, folders)):
        wide.where(F.col("layout") == k).select(*columns).write.option("header", True).csv(folder)
    read = read_snapshot_csv(spark, folders)
    return read.select("snapshot_date", "RTO", "vehicle_type", "Maker", *[F.col(f"`{m}`").try_cast("bigint").alias(m) for m in (*D.MEASURES, EXTRA_FUEL)])


@register("snapshot_catalogue")
def snapshot_catalogue(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNP1, SNP3: the newest files of a folder of dated month-end snapshots and one undated export, by both orders."""
    p = X.Derivation(spark, data_dir)
    ends = p.cumulative_month_end()
    line = F.concat_ws(",", "RTO", "vehicle_type", "Maker", F.col("TOTAL"))
    body = F.concat(F.lit("RTO,vehicle_type,Maker,TOTAL\n"), F.array_join(F.sort_array(F.collect_list(line)), "\n"), F.lit("\n"))
    files = ends.groupBy("timestamp").agg(body.alias("body"))
    files = files.select(F.concat(F.date_format("timestamp", "yyyy-MM-dd"), F.lit(".csv")).alias("name"), "body")
    folder = write_named_files(files, _fresh(spark, "catalogue"))
    write_named_files(spark.createDataFrame([("export.csv", "RTO,vehicle_type,Maker,TOTAL\n")], "name string, body string"), folder)
    listed = snapshot_files(spark, folder)
    picked = [("dated_first", r) for r in newest_files(listed, 2)] + [("mixed", r) for r in newest_files(listed, 2, dated_first=False)]
    rank = {"dated_first": 0, "mixed": 0}
    rows = []
    for order, r in picked:
        rank[order] += 1
        rows.append((order, rank[order], r.name, r.name_date))
    chosen = F.broadcast(spark.createDataFrame(rows, "policy string, rank long, name string, name_date date"))  # four rows
    sizes = read_snapshot_csv(spark, folder).groupBy(F.col("source_file").alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return chosen.join(sizes, "name", "left").select("policy", "rank", "name", "name_date", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


DATE_LAYOUTS = ("d-M-yyyy", "dd.MM.yyyy", "yyyy/MM/dd", "d MMMM yyyy", "MMM d, yyyy", "dd-MMM-yyyy", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy")


@register("mixed_date_layouts")
def mixed_date_layouts(spark: SparkSession, data_dir: str) -> DataFrame:
    """SC11: order dates written in eight layouts (numbers, month names, with a time), parsed back by tokens."""
    t = X.Tables(spark, data_dir)
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % len(DATE_LAYOUTS)
    text = F.coalesce(*[F.when(k == i, F.date_format(day, layout)) for i, layout in enumerate(DATE_LAYOUTS)])
    orders = t.orders.select("o_orderkey", day.alias("order_date"), text.alias("date_text"))
    parsed = parse_mixed_dates(F.col("date_text"))
    return orders.select("o_orderkey", "date_text", parsed.alias("parsed"), (parsed == F.col("order_date")).alias("ok"))
