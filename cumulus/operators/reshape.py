"""Wide <-> long reshapes and column alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import q


def unpivot_wide(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name_col: str, value_col: str, value_type: str | None = None
) -> DataFrame:
    """Wide -> long (RS1). Values are cast to one type first so the unpivot is well typed.

    ``DataFrame.unpivot`` plans as an ``Expand``: one pass, no shuffle.
    """
    if value_type is None:
        types = {t for c, t in df.dtypes if c in values}
        value_type = types.pop() if len(types) == 1 else "double"
    cast = df.select(*[F.col(q(i)).alias(i) for i in ids], *[F.col(q(v)).cast(value_type).alias(v) for v in values])
    return cast.unpivot(list(ids), list(values), name_col, value_col)


def pivot_long(df: DataFrame, ids: Sequence[str], pivot_col: str, values: Sequence[str], agg: Column) -> DataFrame:
    """Long -> wide (RS4) with the pivot values given, so Spark runs no extra distinct job."""
    return df.groupBy(*ids).pivot(pivot_col, list(values)).agg(agg)


def add_missing(df: DataFrame, columns: Sequence[str], value=0, dtype: str = "bigint") -> DataFrame:
    """RS3: add each absent column as a constant (0 by default) so two sides line up."""
    missing = {c: F.lit(value).cast(dtype) for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def union_aligned(master: DataFrame, new: DataFrame) -> DataFrame:
    """UN1/UN2: union all by name; the master's column order first, then new columns.

    Columns missing on a side are NULL there (``allowMissingColumns``).
    """
    order = list(dict.fromkeys([*master.columns, *new.columns]))
    return master.unionByName(new, allowMissingColumns=True).select(*[F.col(q(c)) for c in order])
