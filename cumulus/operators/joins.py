"""Join helpers: null-safe equi-joins and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dimensions and snapshot-date indexes above this many rows are joined with a
# shuffle instead of a broadcast. 2M narrow rows is well below the default
# 8 GB broadcast limit and keeps executor memory per copy small.
DEFAULT_BROADCAST_ROWS = 2_000_000


BROADCAST_ROWS_CONF = "cumulus.broadcast.maxRows"


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only after checking it holds at most ``max_rows`` rows.

    The bound defaults to the session setting ``cumulus.broadcast.maxRows``
    (else 2M rows). The check is one small job (``limit(max_rows + 1).count()``).
    Beyond the bound the frame is returned unchanged and the planner shuffles
    both sides (AQE may still pick a broadcast at run time from real shuffle sizes).
    """
    if max_rows is None:
        max_rows = int(df.sparkSession.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def null_safe_condition(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lcol, rcol in pairs:
        c = left[lcol].eqNullSafe(right[rcol])
        cond = c if cond is None else cond & c
    return cond


def join_null_safe(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    right_prefix: str = "__r_",
) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (pandas ``astype(str)`` keys).

    Right-side key columns are renamed and dropped after the join, so the
    result has one copy of each key, taken from the left for left/inner/semi/anti
    joins and coalesced for full outer joins.
    """
    renamed = right.withColumnsRenamed({k: f"{right_prefix}{k}" for k in keys})
    cond = null_safe_condition(left, renamed, [(k, f"{right_prefix}{k}") for k in keys])
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return joined
    if how in ("full", "full_outer", "outer", "fullouter"):
        joined = joined.withColumns(
            {k: F.coalesce(left[k], renamed[f"{right_prefix}{k}"]) for k in keys}
        )
    elif how in ("right", "right_outer"):
        joined = joined.withColumns({k: renamed[f"{right_prefix}{k}"] for k in keys})
    return joined.drop(*[f"{right_prefix}{k}" for k in keys])
