"""Monthly summaries and reconciliation of facts against the cumulative snapshot (C7-C9).

The correction for a month is ``cumulative - sum(increments)`` per key: rows
appended to the fact table so that its monthly sum equals the portal's
month-to-date figure. Computed as one signed union and one ``groupBy`` (a
single shuffle, NULL keys grouped together) instead of a full outer join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fmt_day_first, parse_day_first, to_number
from ..functions.schema import SUMMARY_ID_COLUMNS, conform, normalize_headers, numeric_columns, q, require_columns
from .reshape import add_missing, union_aligned

# Accepted spellings of the summary's key columns.
SUMMARY_ALIASES = {"RTO": ["RTO", "rto"], "Maker": ["Maker", "maker"]}
SUMMARY_EXTRA_KEYS = ("state", "rto_number", "district")


def _value(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    v = to_number(F.col(q(c))) if t == "string" else F.col(q(c))
    return F.coalesce(v, F.lit(0))


def monthly_summary(
    df: DataFrame,
    month: int | None = None,
    year: int | None = None,
    measures: Sequence[str] | None = None,
    date_col: str = "timestamp",
    by_month: bool = False,
    extra_keys: Sequence[str] = SUMMARY_EXTRA_KEYS,
) -> DataFrame:
    """C7: sums per (RTO, Maker [, state, rto_number, district]) for one month, or per month.

    The date is parsed leniently (unparsable rows drop out of the filter);
    the month filter is a half-open date range, so it prunes partitions and
    pushes down. ``measures`` default to the columns holding any number
    (PRJ6, one aggregate). Vehicle type is collapsed.
    """
    df = normalize_headers(df, SUMMARY_ALIASES)
    require_columns(df, ["RTO", "Maker"])
    d = F.col(date_col) if dict(df.dtypes)[date_col] == "date" else parse_day_first(F.col(q(date_col)))
    df = df.withColumn("__d", d)
    if month is not None and year is not None:
        first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
        df = df.where((F.col("__d") >= first) & (F.col("__d") < F.add_months(first, 1)))
    else:
        df = df.where(F.col("__d").isNotNull())
    if measures is None:
        measures = numeric_columns(df.drop("__d"), exclude=SUMMARY_ID_COLUMNS)
    extras = [c for c in extra_keys if c in df.columns]
    keys = ([F.trunc("__d", "month").alias("month")] if by_month else []) + [
        "RTO",
        "Maker",
        *[F.col(q(c)) for c in extras],
    ]
    return df.groupBy(*keys).agg(*[F.sum(_value(df, m)).alias(m) for m in measures])


def reconcile(left: DataFrame, right: DataFrame, measures: Sequence[str], keys: Sequence[str] = ("RTO", "Maker"),
              extra_keys: Sequence[str] = SUMMARY_EXTRA_KEYS) -> DataFrame:
    """C8 (JN3, RS3): ``left - right`` aligned on keys; a side missing a key or measure counts 0.

    Extra keys are used only when both sides have them. Right-only keys come
    out negative. One shuffle: ``left`` rows with +1, ``right`` rows with -1,
    ``groupBy(keys)``.
    """
    keys = [*keys, *[c for c in extra_keys if c in left.columns and c in right.columns]]

    def signed(df: DataFrame, sign: int) -> DataFrame:
        df = add_missing(df, measures)  # RS3: a measure one side lacks is 0 there
        return df.select(
            *[F.col(q(k)) for k in keys],
            *[(F.coalesce(F.col(q(m)), F.lit(0)) * sign).alias(m) for m in measures],
        )

    both = signed(left, 1).unionByName(signed(right, -1))
    return both.groupBy(*keys).agg(*[F.sum(F.col(q(m))).alias(m) for m in measures])


def filler_rows(diff: DataFrame, layout: Sequence[str], run_date: Column, vehicle_type: str | Column = "motor_car",
                types: dict[str, str] | None = None, row_source: str | None = "filler", data_date: Column | None = None) -> DataFrame:
    """PRJ5: correction rows in the fixed wide layout.

    Stamps ``scrape_timestamp`` = run date and ``timestamp`` = ``data_date``,
    else run date - 1 (``dd-MM-yyyy``), forces the vehicle type, keeps all-zero rows, drops
    columns outside the layout and fills absent ones with typed NULL (the
    literal text ``None`` belongs only in a CSV written for old readers).
    ``row_source`` tags the rows so a same-day replay can spare them.
    """
    vt = vehicle_type if isinstance(vehicle_type, Column) else F.lit(vehicle_type)
    stamped = diff.withColumns(
        {
            "scrape_timestamp": fmt_day_first(run_date),
            "timestamp": fmt_day_first(F.date_sub(run_date, 1) if data_date is None else data_date),
            "vehicle_type": vt,
        }
    )
    out = conform(stamped, layout, types)
    return out.withColumn("row_source", F.lit(row_source)) if row_source else out


def apply_corrections(master: DataFrame, fillers: DataFrame) -> DataFrame:
    """C9 (UN2): append the correction rows, master's column order first."""
    return union_aligned(master, fillers)
