"""Daily increments from month-to-date cumulative snapshots (NEW - OLD).

Semantics kept from the source pipeline:

* keys are compared as trimmed strings and NULL keys match each other;
* measures are summed per key first (NULL only when every value is NULL);
* NEW's rows are kept, OLD-only keys are dropped, negatives are allowed;
* a key or a measure missing on the OLD side counts as 0;
* the first snapshot of a month has no OLD: the increment is the snapshot.

Plan shape: instead of joining NEW to OLD (two shuffles of the snapshot, a
null-safe join, and one pass per measure), every snapshot row is emitted twice
-- as itself (+) and as the OLD side of the next snapshot date (-) -- and one
``groupBy(date, keys)`` adds them up. The aggregate is partial on the map side,
so each task ships at most one row per (date, key) however hot the key, and
the job has a single shuffle. Grouping is null-safe by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import strip_ws, to_number
from ..functions.schema import DELTA_ID_COLUMNS, measure_columns, require_columns
from .joins import bounded_broadcast, join_null_safe
from .snapshots import RESET_MONTH, snapshot_index

_NEW = "__is_new"
_D = "__delta_date"


def _numeric(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Coerce string measures to numbers (bad text -> NULL); numeric ones stay."""
    types = dict(df.dtypes)
    fixes = {m: to_number(F.col(f"`{m}`")) for m in measures if types.get(m) == "string"}
    return df.withColumns(fixes) if fixes else df


def snapshot_delta(
    snapshots: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] | None = None,
    date_col: str = "snapshot_date",
    attributes: Sequence[str] = (),
    reset: str | None = RESET_MONTH,
    trim_keys: bool = True,
    fan_out: bool = False,
    index: DataFrame | None = None,
    period_col: str | None = None,
) -> DataFrame:
    """Increments for every snapshot in one pass.

    Returns one row per (``date_col``, keys) present in each snapshot with the
    increments of ``measures``; ``attributes`` (e.g. state, office code) are
    carried from the NEW rows. With ``fan_out=True`` the result has one row
    per NEW input row, each carrying its whole key group's increment (the
    source's behaviour on duplicate keys).

    ``index`` may pass a precomputed :func:`snapshot_index` whose size the
    caller has already bounded (it is broadcast as is); otherwise it is built
    from the snapshots and broadcast after a size check. ``period_col`` names
    an existing column equal to the month of ``date_col``: with a monthly reset
    the OLD side of a row always lands in the same month, so grouping by the
    period too lets an input already hash-partitioned by (keys, period) skip
    the shuffle entirely.
    """
    keys = list(keys)
    require_columns(snapshots, [date_col, *keys])  # PRJ9
    attributes = [a for a in attributes if a not in keys]
    if measures is None:
        measures = measure_columns(snapshots, exclude=[*DELTA_ID_COLUMNS, date_col, *keys, *attributes])
    measures = list(measures)
    base = snapshots
    if dict(base.dtypes)[date_col] != "date":  # text or timestamp snapshot dates: one calendar day each
        base = base.withColumn(date_col, F.to_date(F.col(f"`{date_col}`")))
    if trim_keys:
        base = base.withColumns({k: strip_ws(F.col(f"`{k}`")) for k in keys})
    base = _numeric(base, measures)

    period = []
    if reset == RESET_MONTH:
        if period_col is None:
            base = base.withColumn("__period", F.trunc(date_col, "month"))
            period_col = "__period"
        period = [period_col]
    narrow = base.select(date_col, *period, *keys, *attributes, *measures)
    if index is None:
        # One row per snapshot date: broadcast after a size check.
        index = bounded_broadcast(snapshot_index(base, date_col, reset).select(date_col, "prev_date", "next_date"))
    else:
        index = F.broadcast(index.select(date_col, "prev_date", "next_date"))
    indexed = narrow.join(index.select(date_col, "next_date"), on=date_col, how="left")

    types = dict(indexed.dtypes)

    def side(is_new: bool):
        # (+) the row as its own snapshot; (-) the row as OLD of the next snapshot.
        fields = [F.lit(1 if is_new else 0).alias(_NEW), F.col(date_col if is_new else "next_date").alias(_D)]
        fields += [F.col(f"`{m}`").alias(m) for m in measures]
        fields += [(F.col(f"`{a}`") if is_new else F.lit(None).cast(types[a])).alias(a) for a in attributes]
        return F.struct(*fields)

    signed = indexed.select(*period, *[F.col(f"`{k}`") for k in keys], F.inline(F.array(side(True), side(False)))).where(
        F.col(_D).isNotNull()
    )

    aggs = [F.max(_NEW).alias(_NEW)]
    for i, m in enumerate(measures):
        aggs.append(F.sum(F.when(F.col(_NEW) == 1, F.col(f"`{m}`"))).alias(f"__n{i}"))
        aggs.append(F.sum(F.when(F.col(_NEW) == 0, F.col(f"`{m}`"))).alias(f"__o{i}"))
    for a in attributes:
        aggs.append(F.max(F.col(f"`{a}`")).alias(a))
    grouped = signed.groupBy(*period, _D, *keys).agg(*aggs).where(F.col(_NEW) == 1)
    out = grouped.select(
        F.col(_D).alias(date_col),
        *[F.col(f"`{k}`") for k in keys],
        *[F.col(f"`{a}`") for a in attributes],
        *[(F.coalesce(F.col(f"__n{i}"), F.lit(0)) - F.coalesce(F.col(f"__o{i}"), F.lit(0))).alias(m) for i, m in enumerate(measures)],
    )
    if not fan_out:
        return out
    # Compatibility: every NEW row (duplicates included) carries its group's increment;
    # a snapshot without predecessor (month reset) is copied row by row, as the source does.
    rows = base.select(date_col, *keys, *attributes, *[F.col(f"`{m}`").alias(f"__own{i}") for i, m in enumerate(measures)])
    rows = rows.join(index.select(date_col, "prev_date"), on=date_col, how="left")
    incr = out.select(date_col, *keys, *measures)
    joined = join_null_safe(rows, incr, [date_col, *keys], how="left")
    raw = F.col("prev_date").isNull()
    return joined.select(
        date_col, *keys, *attributes,
        *[F.when(raw, F.col(f"__own{i}")).otherwise(F.col(f"`{m}`")).alias(m) for i, m in enumerate(measures)],
    )


def delta_pair(
    old: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] | None = None,
    attributes: Sequence[str] = (),
    trim_keys: bool = True,
    fan_out: bool = False,
) -> DataFrame:
    """Increments between two snapshots given as separate frames.

    Measures are NEW's non-key columns; a measure OLD lacks counts as 0 and
    OLD-only columns are ignored. Without OLD (first run of a month) the NEW
    snapshot is returned as its own increment. One shuffle: both sides are
    unioned with a sign and grouped by key. ``fan_out=True`` is the source's
    form: every NEW row carries its key group's increment, and without OLD
    the NEW rows are returned one by one.
    """
    keys = list(keys)
    require_columns(new, keys)  # PRJ9: keys on both sides
    if old is not None:
        require_columns(old, keys)
    attributes = [a for a in attributes if a not in keys]
    if measures is None:
        measures = measure_columns(new, exclude=[*DELTA_ID_COLUMNS, *keys, *attributes])
    measures = list(measures)
    if trim_keys:
        new = new.withColumns({k: strip_ws(F.col(f"`{k}`")) for k in keys})
    new = _numeric(new, measures)
    new_part = new.select(*keys, *attributes, *[F.col(f"`{m}`") for m in measures]).withColumn(_NEW, F.lit(1))
    if old is None:
        parts = new_part
    else:
        if trim_keys:
            old = old.withColumns({k: strip_ws(F.col(f"`{k}`")) for k in keys})
        present = [m for m in measures if m in old.columns]
        old = _numeric(old, present)
        new_types = dict(new.dtypes)
        old_part = old.select(
            *keys,
            *[F.lit(None).cast(new_types[a]).alias(a) for a in attributes],
            *[F.col(f"`{m}`") if m in present else F.lit(None).cast(new_types[m]).alias(m) for m in measures],
        ).withColumn(_NEW, F.lit(0))
        parts = new_part.unionByName(old_part)
    aggs = [F.max(_NEW).alias(_NEW)]
    for i, m in enumerate(measures):
        aggs.append(F.sum(F.when(F.col(_NEW) == 1, F.col(f"`{m}`"))).alias(f"__n{i}"))
        aggs.append(F.sum(F.when(F.col(_NEW) == 0, F.col(f"`{m}`"))).alias(f"__o{i}"))
    for a in attributes:
        aggs.append(F.max(F.col(f"`{a}`")).alias(a))
    grouped = parts.groupBy(*keys).agg(*aggs).where(F.col(_NEW) == 1)
    out = grouped.select(
        *[F.col(f"`{k}`") for k in keys],
        *[F.col(f"`{a}`") for a in attributes],
        *[(F.coalesce(F.col(f"__n{i}"), F.lit(0)) - F.coalesce(F.col(f"__o{i}"), F.lit(0))).alias(m) for i, m in enumerate(measures)],
    )
    if not fan_out:
        return out
    rows = new.select(*keys, *attributes, *[F.col(f"`{m}`") for m in measures])
    if old is None:
        return rows
    return join_null_safe(rows.drop(*measures), out.select(*keys, *measures), keys, how="left")
