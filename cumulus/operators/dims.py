"""Dimension tables and lookups (JN4, JN5, JN7, SRC5-SRC8).

Dimensions are small tables: literal maps become DataFrames whose size is
known in the driver (broadcast is safe); dimension files are broadcast only
after a row-count check (:func:`read_json_map`); dimension tables are left to
the planner, which broadcasts them by its size estimate (or AQE by the real
size) and otherwise shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import strip_ws
from .joins import bounded_broadcast

# --- Fixed values of the vehicle-registration domain (must equal the source) --
# Makers kept when reading a report (after stripping whitespace).
TARGET_MAKERS = [
    "MARUTI SUZUKI INDIA LTD",
    "HONDA CARS INDIA LTD",
    "HYUNDAI MOTOR INDIA LTD",
    "JSW MG MOTOR INDIA PVT LTD",
    "KIA INDIA PRIVATE LIMITED",
    "MAHINDRA & MAHINDRA LIMITED",
    "NISSAN MOTOR INDIA PVT LTD",
    "SKODA AUTO VOLKSWAGEN INDIA PVT LTD",
    "TATA MOTORS PASSENGER VEHICLES LTD",
    "TATA PASSENGER ELECTRIC MOBILITY LTD",
    "TOYOTA KIRLOSKAR MOTOR PVT LTD",
    "RENAULT INDIA PVT LTD",
    "MAHINDRA ELECTRIC AUTOMOBILE LTD",
    "STELLANTIS AUTOMOBILES INDIA PVT LTD",
    "STELLANTIS INDIA PVT LTD",
    "BYD INDIA PRIVATE LIMITED",
    "VINFAST AUTO INDIA PVT LTD",
    "VOLKSWAGEN AG",
    "TATA MOTORS LTD",
    "SKODA AUTO AS",
]
# Maker -> short brand name.
MAKER_SHORT = {
    "MARUTI SUZUKI INDIA LTD": "Maruti",
    "HONDA CARS INDIA LTD": "Honda",
    "HYUNDAI MOTOR INDIA LTD": "Hyundai",
    "JSW MG MOTOR INDIA PVT LTD": "MG",
    "KIA INDIA PRIVATE LIMITED": "KIA",
    "MAHINDRA & MAHINDRA LIMITED": "Mahindra",
    "NISSAN MOTOR INDIA PVT LTD": "Nissan",
    "SKODA AUTO VOLKSWAGEN INDIA PVT LTD": "Skoda",
    "TATA MOTORS PASSENGER VEHICLES LTD": "Tata",
    "TATA PASSENGER ELECTRIC MOBILITY LTD": "Tata",
    "TOYOTA KIRLOSKAR MOTOR PVT LTD": "Toyota",
    "RENAULT INDIA PVT LTD": "Renault",
    "MAHINDRA ELECTRIC AUTOMOBILE LTD": "Mahindra",
    "STELLANTIS AUTOMOBILES INDIA PVT LTD": "PCA",
    "STELLANTIS INDIA PVT LTD": "Fiat",
    "BYD INDIA PRIVATE LIMITED": "BYD",
    "VINFAST AUTO INDIA PVT LTD": "Vinfast",
    "VOLKSWAGEN AG": "VW",
    "TATA MOTORS LTD": "Tata",
    "SKODA AUTO AS": "Skoda",
}
# Fuel group -> fuel columns it collects.
FUEL_GROUPS = {
    "CNG": ["CNG ONLY", "PETROL/CNG", "PETROL(E20)/CNG"],
    "Diesel": ["DIESEL"],
    "Petrol": ["PETROL", "PETROL(E20)", "PETROL/ETHANOL"],
    "EV": ["ELECTRIC(BOV)", "PURE EV"],
    "Petrol-Hybrid": ["PETROL/HYBRID", "PETROL(E20)/HYBRID"],
    "Diesel-Hybrid": ["DIESEL/HYBRID"],
    "Strong-Hybrid": ["STRONG HYBRID EV"],
}
# State -> sales zone.
ZONE_BY_STATE = {"Karnataka": "S1", "Tamil Nadu": "S2", "Puducherry": "S2", "Kerala": "S3"}
# Default district when an office is not in the district map.
UNKNOWN_DISTRICT = "Unknown"
# ------------------------------------------------------------------------------


def map_dim(spark: SparkSession, mapping: Mapping[str, str | None], key: str, value: str) -> DataFrame:
    """A literal map as a two-column dimension, marked for broadcast (size known here)."""
    rows = [(k, v) for k, v in mapping.items()]
    df = spark.createDataFrame(rows, f"`{key}` string, `{value}` string")
    return F.broadcast(df)


def groups_dim(spark: SparkSession, groups: Mapping[str, Sequence[str]], member: str, group: str) -> DataFrame:
    """Group -> list map as a dimension, inverted with ``explode`` inside Spark (RS2)."""
    m = spark.createDataFrame([(g, list(ms)) for g, ms in groups.items()], f"`{group}` string, members array<string>")
    return F.broadcast(m.select(F.explode("members").alias(member), F.col(f"`{group}`")))


def read_json_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A JSON object file ``{"k": "v", ...}`` -> (key, value) rows (SRC5), size-checked broadcast."""
    raw = spark.read.text(path, wholetext=True)
    pairs = raw.select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))
    return bounded_broadcast(pairs)


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[tuple[str, str]],
    values: Sequence[str],
    default: Mapping[str, str] | None = None,
    upper_key: bool = False,
) -> DataFrame:
    """Left lookup of ``values`` from ``dim`` (JN4); a miss is NULL or ``default`` (JN5).

    ``on`` is a column name present in both, or ``[(fact_col, dim_col)]``.
    ``upper_key`` matches on the upper-cased fact key (district map style).
    The dimension must be unique on its key, like the dict it replaces.
    """
    pairs = [(on, on)] if isinstance(on, str) else list(on)
    d = dim.select(*[F.col(dc).alias(f"__dk{i}") for i, (_, dc) in enumerate(pairs)], *values)
    cond = None
    for i, (fc, _) in enumerate(pairs):
        fk = F.upper(facts[fc]) if upper_key else facts[fc]
        c = fk == d[f"__dk{i}"]
        cond = c if cond is None else cond & c
    out = facts.join(d, cond, "left").drop(*[f"__dk{i}" for i in range(len(pairs))])
    if default:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in default.items()})
    return out


def unmapped(facts: DataFrame, dim: DataFrame, fact_col: str, dim_col: str) -> DataFrame:
    """Distinct non-NULL values of ``fact_col`` with no row in ``dim`` (JN7 + DD2): anti join + distinct."""
    vals = facts.select(F.col(fact_col).alias("value")).where(F.col("value").isNotNull())
    keys = dim.select(F.col(dim_col).alias("value"))
    return vals.join(keys, "value", "left_anti").distinct()


def keep_listed(facts: DataFrame, column: str, allowed: DataFrame, allowed_col: str, strip: bool = True) -> DataFrame:
    """Keep rows whose (stripped) ``column`` is listed in ``allowed`` (FLT2): broadcast left-semi join."""
    f = facts.withColumn(column, strip_ws(F.col(column))) if strip else facts
    return f.join(allowed.select(F.col(allowed_col).alias("__allowed")), F.col(column) == F.col("__allowed"), "left_semi")
