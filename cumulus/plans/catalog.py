"""Registered queries: each maps the counter domain onto the driver tables.

Every function takes ``(spark, data_dir)`` and returns a lazy DataFrame over
the whole tables. Column names equal the oracle SQL's (see ``oracle.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import delta_pair, snapshot_delta
from ..operators.reshape import pivot_long, unpivot_wide
from ..operators.snapshots import snapshot_index
from ..session import materialize
from ..sources.tables import Tables
from . import domain as D
from . import fixtures as X

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def _snap(spark: SparkSession, data_dir: str):
    """(tables, calendar, snapshots, snapshot index) of the derived pipeline (see ``fixtures.Derivation``)."""
    p = X.Derivation(spark, data_dir)
    return p.t, p.days, p.snap, p.idx


# --- C2: snapshot deltas ------------------------------------------------------


@register("delta_all_snapshots")
def delta_all_snapshots(spark: SparkSession, data_dir: str) -> DataFrame:
    """C2 over every snapshot in one pass (SNP1-2, WN1, AG1, JN1)."""
    return X.Derivation(spark, data_dir).delta


@register("delta_no_reset")
def delta_no_reset(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNP1 without the monthly reset: OLD is the previous snapshot even across a month boundary.

    The predecessor index is one ordered chain over the calendar (one row per
    day, size-checked), so the snapshots are derived once.
    """
    _, _, snap, idx = _snap(spark, data_dir)
    chain = snapshot_index(idx.select("snapshot_date"), reset=None)
    return snapshot_delta(snap.drop("month"), D.KEYS, D.MEASURES, reset=None, trim_keys=False, index=chain)


@register("delta_latest_pair")
def delta_latest_pair(spark: SparkSession, data_dir: str) -> DataFrame:
    """C2 on the newest snapshot and its predecessor only (LM1); a month start is a raw copy."""
    _, _, snap, idx = _snap(spark, data_dir)
    pair = idx.orderBy(F.col("snapshot_date").desc()).limit(1).select(
        F.col("snapshot_date").alias("new_date"), F.col("prev_date").alias("old_date")
    )
    pair = F.broadcast(pair)  # one row
    new = snap.join(pair, snap.snapshot_date == pair.new_date, "left_semi")
    old = snap.join(pair, snap.snapshot_date == pair.old_date, "left_semi")
    out = delta_pair(old, new.drop("month"), D.KEYS, D.MEASURES, attributes=["snapshot_date"])
    return out.select("snapshot_date", *D.KEYS, *D.MEASURES)


@register("delta_month_reset")
def delta_month_reset(spark: SparkSession, data_dir: str) -> DataFrame:
    """SNP2: on the first snapshot of each month the increment equals the snapshot."""
    _, _, snap, idx = _snap(spark, data_dir)
    delta = snapshot_delta(snap, D.KEYS, D.MEASURES, index=idx, period_col="month", trim_keys=False)
    firsts = idx.where(F.col("prev_date").isNull()).select("snapshot_date")
    d = delta.join(firsts, "snapshot_date", "left_semi").groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("keys_on_first_day"), F.sum("TOTAL").alias("delta_total")
    )
    s = snap.join(firsts, "snapshot_date", "left_semi").groupBy("snapshot_date").agg(F.sum("TOTAL").alias("snapshot_total"))
    return d.join(s, "snapshot_date").select(
        F.trunc("snapshot_date", "month").alias("month"),
        F.col("snapshot_date").alias("first_day"),
        "keys_on_first_day",
        "delta_total",
        "snapshot_total",
    )


@register("delta_dup_keys_compat")
def delta_dup_keys_compat(spark: SparkSession, data_dir: str) -> DataFrame:
    """JN2: key (office, vehicle_type) repeats per maker; each row carries the group increment.

    The rows and their groups both read the snapshot, so it is stored once, as in the jobs, and not derived twice.
    """
    _, _, snap, idx = _snap(spark, data_dir)
    return snapshot_delta(
        materialize(snap, "snapshots"), ["office", "vehicle_type"], D.MEASURES, attributes=["maker"], index=idx, period_col="month", fan_out=True,
        trim_keys=False,
    ).select("snapshot_date", *D.KEYS, *D.MEASURES)


@register("delta_new_column")
def delta_new_column(spark: SparkSession, data_dir: str) -> DataFrame:
    """PRJ7 / pair semantics: a measure only in NEW counts OLD as 0; OLD-only columns drop."""
    _, _, snap, idx = _snap(spark, data_dir)
    pair = F.broadcast(
        idx.where(F.col("prev_date").isNotNull())
        .orderBy(F.col("snapshot_date").desc())
        .limit(1)
        .select(F.col("snapshot_date").alias("new_date"), F.col("prev_date").alias("old_date"))
    )
    new = snap.join(pair, snap.snapshot_date == pair.new_date, "left_semi").withColumn(
        "HIGH_OR_URGENT", F.col("`1-URGENT`") + F.col("`2-HIGH`")
    )
    old = (
        snap.join(pair, snap.snapshot_date == pair.old_date, "left_semi")
        .withColumn("LEGACY", F.col("TOTAL"))
        .drop("5-LOW")
    )
    measures = [*D.MEASURES, "HIGH_OR_URGENT"]
    return delta_pair(old, new, D.KEYS, measures, attributes=["snapshot_date"]).select("snapshot_date", *D.KEYS, *measures)


@register("delta_null_keys")
def delta_null_keys(spark: SparkSession, data_dir: str) -> DataFrame:
    """Null-safe, whitespace-exact keys: NULL makers match; a trailing tab on odd days is trimmed."""
    _, _, snap, idx = _snap(spark, data_dir)
    messy = snap.withColumns(
        {
            "maker": F.when(F.col("maker") != "HOUSEHOLD", F.col("maker")),
            "office": F.when(F.dayofmonth("snapshot_date") % 2 == 1, F.concat("office", F.lit("\t"))).otherwise(F.col("office")),
        }
    )
    return snapshot_delta(messy, D.KEYS, D.MEASURES, index=idx, period_col="month").select("snapshot_date", *D.KEYS, *D.MEASURES)


# --- RS: reshape ----------------------------------------------------------------


@register("pivot_snapshot")
def pivot_snapshot(spark: SparkSession, data_dir: str) -> DataFrame:
    """RS4: long (day, key, fuel) counts -> one column per fuel, explicit pivot values."""
    t = Tables(spark, data_dir)
    facts = D.order_facts(t)
    wide = pivot_long(facts, ["day", *D.KEYS], "fuel", D.FUELS, F.count(F.lit(1)))
    return wide.select("day", *D.KEYS, *[F.coalesce(F.col(f"`{p}`"), F.lit(0)).cast("bigint").alias(p) for p in D.FUELS])


@register("unpivot_measures")
def unpivot_measures(spark: SparkSession, data_dir: str) -> DataFrame:
    """RS1 + FLT3: lineitem's four measures -> (measure, value) rows, zeros dropped."""
    t = Tables(spark, data_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    long = unpivot_wide(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "measure", "value")
    return long.where(F.col("value") != 0)


def queries() -> dict[str, Query]:
    from . import catalog_more, catalog_store  # noqa: F401  (register the remaining queries)

    return dict(REGISTRY)
