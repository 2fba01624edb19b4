"""Long, dimension-conformed mart with fiscal calendar, audit totals and MTD slice (C4-C6)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import fiscal_quarter, fiscal_year, month_name, parse_day_first_strict, to_number
from ..functions.schema import MART_ID_COLUMNS, q, rename_drop
from .dims import groups_dim, lookup, map_dim
from .reshape import unpivot_wide

MART_COLUMNS = [*MART_ID_COLUMNS, "FuelGroup", "Regn Vol", "Zone", "FY", "month", "Qtr"]


def prepare_master(master: DataFrame) -> DataFrame:
    """PRJ3 + SC11: rename ``Maker``->``OEM``, ``timestamp``->``Date`` (strict day-first parse); drop run stamp and district."""
    df = rename_drop(master, {"Maker": "OEM", "timestamp": "Date"}, drop=["scrape_timestamp", "district"])
    if dict(df.dtypes).get("Date") == "string":
        df = df.withColumn("Date", parse_day_first_strict(F.col("Date")))
    else:
        df = df.withColumn("Date", F.to_date("Date"))
    return df


def fuel_columns(df: DataFrame, ids: Sequence[str] = MART_ID_COLUMNS, total: str = "TOTAL") -> list[str]:
    """PRJ8: every column that is not a mart id and not the total is melted as a fuel."""
    skip = {*ids, total}
    return [c for c in df.columns if c not in skip]


def build_mart(
    spark: SparkSession,
    master: DataFrame,
    office_dim: DataFrame,
    fuel_groups: Mapping[str, Sequence[str]],
    maker_short: Mapping[str, str],
    zone_by_state: Mapping[str, str],
    stages: StageTotals | None = None,
) -> DataFrame:
    """C4: wide increments -> long ``(ids, FuelGroup, Regn Vol)`` with dims and fiscal calendar.

    ``office_dim`` has ``RTO, cluster, city, AO`` (unique on RTO). Plan: melt
    (an ``Expand``, no shuffle), drop zero volume, inner-join the broadcast fuel
    map (unmapped fuels drop), one ``groupBy`` with map-side partial sums, and
    only then the dimension lookups on the already-aggregated rows (all
    broadcast). The dims are functions of RTO / OEM / state, so looking them up
    after the aggregate gives the same groups as before it, on fewer rows. With
    ``stages`` the plan measures itself at four places (see :class:`StageTotals`).
    """
    watch = stages.watch if stages else lambda df, *_: df
    df = prepare_master(master)
    fuels = fuel_columns(df)
    base_ids = ["Date", "state", "RTO", "rto_number", "vehicle_type", "OEM"]
    for c in base_ids:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    types = dict(df.dtypes)
    if stages:
        df = watch(df, "initial", _row_volume(df, fuels))
        df = watch(df.join(_without_ao(df, office_dim), "RTO", "left"), "offices", None, missing_ao_rows=F.count_if(F.col("__no_ao").isNotNull() | F.col("RTO").isNull()))
    if any(types[c] == "string" for c in fuels):  # CSV input: lenient parse, bad -> 0
        long = unpivot_wide(df, base_ids, fuels, "FuelType", "__raw", value_type="string")
        vol = F.coalesce(to_number(F.col("__raw")), F.lit(0.0))
    else:
        long = unpivot_wide(df, base_ids, fuels, "FuelType", "__raw", value_type="bigint")
        vol = F.coalesce(F.col("__raw"), F.lit(0))
    long = long.withColumn("Regn Vol", vol).where(F.col("Regn Vol") != 0).drop("__raw")
    volume = F.col("`Regn Vol`")
    long = watch(long, "after_melt", volume)
    fuel_map = groups_dim(spark, fuel_groups, "FuelType", "FuelGroup")
    mapped = watch(long.join(fuel_map, "FuelType", "inner"), "after_fuel_map", volume)
    grouped = mapped.groupBy(*base_ids, "FuelGroup").agg(F.sum("Regn Vol").alias("Regn Vol"))
    grouped = lookup(grouped, office_dim, "RTO", ["cluster", "city", "AO"])
    grouped = lookup(grouped, map_dim(spark, maker_short, "OEM", "maker_short"), "OEM", ["maker_short"])
    grouped = lookup(grouped, map_dim(spark, zone_by_state, "state", "Zone"), "state", ["Zone"])
    grouped = watch(grouped, "final", volume)
    d = F.col("Date")
    return grouped.select(
        *[F.col(q(c)) for c in MART_ID_COLUMNS],
        "FuelGroup",
        F.col("`Regn Vol`").cast("bigint").alias("Regn Vol"),
        "Zone",
        fiscal_year(d).alias("FY"),
        month_name(d).alias("month"),
        fiscal_quarter(d).alias("Qtr"),
    )


class StageTotals:
    """AG4: sums and row counts observed at stages of a plan while it runs; read them after its first action.

    The counts come from the tasks themselves. A stage that Spark runs again
    after losing an executor can count twice, so the stored result is held
    against the last stage too (:func:`audited_mart`).
    """

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str, volume: Column | None, **more: Column) -> DataFrame:
        self.seen[stage] = Observation(f"{stage}-{uuid.uuid4().hex}")
        sums = {} if volume is None else {"total": F.sum(volume.cast("double"))}
        return df.observe(self.seen[stage], *[e.alias(n) for n, e in {**sums, "rows": F.count(F.lit(1)), **more}.items()])

    def get(self, stage: str, name: str = "total") -> float:
        return self.seen[stage].get[name] or 0


def _row_volume(df: DataFrame, fuels: Sequence[str]) -> Column:
    types = dict(df.dtypes)
    parts = [F.coalesce(to_number(F.col(q(c))) if types[c] == "string" else F.col(q(c)).cast("double"), F.lit(0.0)) for c in fuels]
    return sum(parts, F.lit(0.0))


def _without_ao(df: DataFrame, office_dim: DataFrame) -> DataFrame:
    """``RTO, __no_ao``: offices of the facts without an area office, once each (so the join adds no row)."""
    known = office_dim.where("AO is not null").select("RTO").distinct()
    return df.select("RTO").distinct().join(known, "RTO", "left_anti").withColumn("__no_ao", F.lit(True))


@dataclass(frozen=True)
class Audit:
    row: DataFrame  # one row: totals by stage, unmapped fuels, rows without an AO, verdict
    periods: list[str]  # periods that the run wrote


def audited_mart(
    spark: SparkSession,
    master: DataFrame,
    office_dim: DataFrame,
    fuel_groups: Mapping[str, Sequence[str]],
    maker_short: Mapping[str, str],
    zone_by_state: Mapping[str, str],
    path: str,
    tolerance: float = 0.01,
) -> Audit:
    """C4 + C5: write the mart by period and return what was measured while writing it.

    ``initial`` is the volume of all fuel columns of the wide rows,
    ``after_melt`` and ``after_fuel_map`` that of the long rows, ``final`` that
    of the rows that reach the mart; each is observed in the one plan that
    writes it, so a join that loses or repeats rows shows. ``written`` is the
    volume of the stored periods. The verdict compares initial and final as the
    source does, and the stored rows with the final stage.
    """
    stages = StageTotals()
    mart = build_mart(spark, master, office_dim, fuel_groups, maker_short, zone_by_state, stages)
    mart = mart.withColumn("period", F.date_format("Date", "yyyy-MM"))
    seen = Observation(f"periods-{uuid.uuid4().hex}")
    mart.observe(seen, F.collect_set("period").alias("periods")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("period").parquet(path)
    periods = sorted(seen.get["periods"] or [])  # one value a month
    stored = spark.read.schema(mart.schema).parquet(path).where(F.col("period").isin(periods))
    written = stored.agg(F.sum("Regn Vol")).first()[0] or 0
    initial, melted, mapped, final = (stages.get(s) for s in ("initial", "after_melt", "after_fuel_map", "final"))
    if abs(initial - final) <= tolerance:
        verdict = "preserved" if abs(final - written) <= tolerance else "stored rows differ"
    else:
        verdict = "loss" if initial > final else "gain"
    row = (
        *map(int, (initial, melted, mapped, final, written)),
        int(stages.get("after_melt", "rows") - stages.get("after_fuel_map", "rows")), int(melted - mapped),
        int(stages.get("offices", "missing_ao_rows")), verdict,
    )
    schema = "initial_total long, after_melt_total long, after_fuel_map_total long, final_total long, written_total long, " \
        "unmapped_fuel_rows long, unmapped_fuel_volume long, missing_ao_rows long, verdict string"
    return Audit(spark.createDataFrame([row], schema), periods)


def audit_totals(master: DataFrame, office_dim: DataFrame, fuel_groups: Mapping[str, Sequence[str]], tolerance: float = 0.01) -> DataFrame:
    """C5 (AG4, AG5): totals at each mart stage and the verdict, in one aggregate over the wide rows.

    initial = all fuel columns; after melt = non-zero volume (same sum);
    after fuel mapping = mapped fuels only; final = after the group-by (same
    as mapped). Also counts rows without an AO and unmapped fuel rows/volume.
    The fuel map is a literal, so mapped/unmapped columns are known here and
    no melt or shuffle is needed: one pass, one output row.
    """
    df = prepare_master(master)
    fuels = fuel_columns(df)
    mapped = {m for ms in fuel_groups.values() for m in ms}
    df = lookup(df, office_dim.select("RTO", "AO"), "RTO", ["AO"]) if "AO" not in df.columns else df
    types = dict(df.dtypes)
    vol = {
        c: F.coalesce(to_number(F.col(q(c))) if types[c] == "string" else F.col(q(c)).cast("double"), F.lit(0.0))
        for c in fuels
    }
    zero = F.lit(0.0)
    initial = sum((vol[c] for c in fuels), zero)
    mapped_sum = sum((vol[c] for c in fuels if c in mapped), zero)
    unmapped_sum = sum((vol[c] for c in fuels if c not in mapped), zero)
    unmapped_rows = sum(((vol[c] != 0).cast("long") for c in fuels if c not in mapped), F.lit(0).cast("long"))
    agg = df.agg(
        F.sum(initial).alias("initial_total"),
        F.sum(initial).alias("after_melt_total"),
        F.sum(mapped_sum).alias("after_fuel_map_total"),
        F.sum(mapped_sum).alias("final_total"),
        F.sum(unmapped_rows).alias("unmapped_fuel_rows"),
        F.sum(unmapped_sum).alias("unmapped_fuel_volume"),
        F.count_if(F.col("AO").isNull()).alias("missing_ao_rows"),
    )
    diff = F.coalesce(F.col("initial_total"), zero) - F.coalesce(F.col("final_total"), zero)
    return agg.select(
        *[F.coalesce(F.col(c), zero).cast("bigint").alias(c) for c in
          ["initial_total", "after_melt_total", "after_fuel_map_total", "final_total"]],
        F.coalesce(F.col("unmapped_fuel_rows"), F.lit(0)).cast("bigint").alias("unmapped_fuel_rows"),
        F.coalesce(F.col("unmapped_fuel_volume"), zero).cast("bigint").alias("unmapped_fuel_volume"),
        F.col("missing_ao_rows").cast("bigint").alias("missing_ao_rows"),
        F.when(F.abs(diff) <= tolerance, "preserved").when(diff > 0, "loss").otherwise("gain").alias("verdict"),
    )


def month_to_date(mart: DataFrame, date_col: str = "Date") -> DataFrame:
    """C6 (FLT6, AG6): rows from the 1st of the latest month up to the latest date.

    The latest date is a scalar subquery (one value), so the filter reaches
    the scan as a runtime predicate and no join is planned.
    """
    latest = mart.select(F.max(date_col)).scalar()
    return mart.where((F.col(date_col) >= F.trunc(latest, "month")) & (F.col(date_col) <= latest))
