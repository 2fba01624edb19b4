"""Derived inputs for the mart / reconciliation / quality queries.

Each relation is built by Spark from the driver tables (so its size grows
with them) and has a SQL twin used by the oracle statements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import fmt_day_first
from ..operators.delta import snapshot_delta
from ..operators.dims import lookup
from ..sources.tables import Tables
from . import domain as D

# --- Fixed values of the test domain --------------------------------------------
# Regions whose offices the geography dimension covers (MIDDLE EAST is left out,
# so its offices exercise the unmapped paths).
COVERED_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
# Maker -> short name (HOUSEHOLD left unmapped).
MAKER_SHORT_T = {"AUTOMOBILE": "Auto", "BUILDING": "Build", "FURNITURE": "Furn", "MACHINERY": "Mach"}
# Fuel group -> fuel columns ("4-NOT SPECIFIED" left unmapped).
FUEL_GROUPS_T = {"Express": ["1-URGENT", "2-HIGH"], "Standard": ["3-MEDIUM"], "Economy": ["5-LOW"]}
# State -> zone (MIDDLE EAST left unmapped).
ZONE_T = {"AFRICA": "Z1", "AMERICA": "Z2", "ASIA": "Z2", "EUROPE": "Z3"}
# Office-code prefix -> state for file names of the test domain.
STATE_BY_PREFIX_T = {"AF": "AFRICA", "AM": "AMERICA", "AS": "ASIA", "EU": "EUROPE"}
# Whitelisted makers for the report reader.
MAKER_WHITELIST_T = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
VEHICLE_TYPES = ["motor_car", "motor_cab"]
# -------------------------------------------------------------------------------

MASTER_LAYOUT = ["scrape_timestamp", "timestamp", "state", "RTO", "rto_number", "vehicle_type", "district", "Maker",
                 *D.MEASURES]


def _sql_list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


# --- dimensions -------------------------------------------------------------------


def geo_dim(t: Tables) -> DataFrame:
    """Office -> cluster, city, AO for the covered regions (one row per office)."""
    n, r = t.nation, t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).where(F.col("r_name").isin(*COVERED_REGIONS)).select(
        F.col("n_name").alias("RTO"),
        F.col("r_name").alias("cluster"),
        F.lower("n_name").alias("city"),
        F.concat(F.lit("AO-"), F.col("n_regionkey").cast("string")).alias("AO"),
    )


GEO_SQL = (
    "SELECT n.n_name AS RTO, r.r_name AS cluster, lower(n.n_name) AS city, 'AO-' || CAST(n.n_regionkey AS VARCHAR) AS AO "
    f"FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ({_sql_list(COVERED_REGIONS)})"
)


def district_dim(t: Tables) -> DataFrame:
    """Office (upper case) -> district for the covered regions."""
    n, r = t.nation, t.region
    return n.join(r, n.n_regionkey == r.r_regionkey).where(F.col("r_name").isin(*COVERED_REGIONS)).select(
        F.upper("n_name").alias("office_key"), F.concat(F.lit("D-"), F.col("r_name")).alias("district")
    )


DISTRICT_SQL = (
    "SELECT upper(n.n_name) AS office_key, 'D-' || r.r_name AS district "
    f"FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ({_sql_list(COVERED_REGIONS)})"
)


def _values_sql(pairs, cols) -> str:
    rows = ", ".join("(" + ", ".join("'" + x + "'" for x in p) + ")" for p in pairs)
    return f"SELECT * FROM (VALUES {rows}) AS v({', '.join(cols)})"


MAKER_SQL = _values_sql(MAKER_SHORT_T.items(), ["OEM", "maker_short"])
FUEL_SQL = _values_sql([(f, g) for g, fs in FUEL_GROUPS_T.items() for f in fs], ["FuelType", "FuelGroup"])
ZONE_SQL = _values_sql(ZONE_T.items(), ["state", "Zone"])


# --- master fact table (F4 shape) ---------------------------------------------------


def with_office_attrs(t: Tables, df: DataFrame, office_col: str = "office") -> DataFrame:
    """Add state, office code (rto_number) and district (default 'Unknown') to keyed rows."""
    od = D.office_dim(t).select(F.col("office").alias("__o"), F.col("state"), F.col("office_code").alias("rto_number"))
    out = df.join(od, df[office_col] == od["__o"], "left").drop("__o")
    return lookup(out, district_dim(t), [(office_col, "office_key")], ["district"], default={"district": "Unknown"}, upper_key=True)


class Derivation:
    """The derived snapshot -> increment pipeline of one query, built once.

    Every branch of a query that needs the snapshots, the index or the
    increments uses these same DataFrames, so the plan holds one copy of each
    subtree and the shuffles under them are computed once and reused.
    """

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.t = Tables(spark, data_dir)
        self.days = D.checked_calendar(self.t)
        self.snap = D.mtd_snapshots(self.t, days=self.days)
        # One row per calendar day: its bound is the checked calendar's.
        self.idx = F.broadcast(D.snapshot_index_for(self.days))
        self.delta = snapshot_delta(self.snap, D.KEYS, D.MEASURES, index=self.idx, period_col="month", trim_keys=False)

    def month_end(self) -> DataFrame:
        """``(month, last_day)``: the last snapshot day of every month (one row per month)."""
        return self.idx.where(F.col("next_date").isNull()).select(
            F.trunc("snapshot_date", "month").alias("month"), F.col("snapshot_date").alias("last_day")
        )

    def master(self, missed_run: bool = False) -> DataFrame:
        """Daily increments in the wide master layout; dates as ``dd-MM-yyyy`` text.

        ``missed_run`` leaves out the increments of vehicle type ``P`` on the
        15th of each month, as if that day's files for one vehicle type never arrived.
        """
        delta = self.delta
        if missed_run:
            delta = delta.where(~((F.dayofmonth("snapshot_date") == 15) & (F.col("vehicle_type") == "P")))
        rows = with_office_attrs(self.t, delta)
        return rows.select(
            fmt_day_first(F.date_add("snapshot_date", 1)).alias("scrape_timestamp"),
            fmt_day_first(F.col("snapshot_date")).alias("timestamp"),
            "state",
            F.col("office").alias("RTO"),
            "rto_number",
            "vehicle_type",
            "district",
            F.col("maker").alias("Maker"),
            *[F.col(f"`{m}`") for m in D.MEASURES],
        )

    def cumulative_month_end(self) -> DataFrame:
        """The last snapshot of every month in the wide layout (the portal's month-to-date figure)."""
        ends = F.broadcast(self.month_end().select(F.col("last_day").alias("snapshot_date")))
        last = self.snap.join(ends, "snapshot_date", "left_semi")
        rows = with_office_attrs(self.t, last)
        return rows.select(
            F.col("snapshot_date").alias("timestamp"), "state", F.col("office").alias("RTO"), "rto_number", "vehicle_type",
            "district", F.col("maker").alias("Maker"), *[F.col(f"`{m}`") for m in D.MEASURES],
        )


def master_facts(spark: SparkSession, data_dir: str, missed_run: bool = False) -> DataFrame:
    """Daily increments in the wide master layout (see :meth:`Derivation.master`)."""
    return Derivation(spark, data_dir).master(missed_run)


def _delta_sql_body() -> str:
    cols = ", ".join(f'CAST("{m}" AS BIGINT) AS "{m}"' for m in D.MEASURES)
    return f"""{D.DENSE_SQL},
delta AS (SELECT snapshot_date, office, vehicle_type, maker, {cols} FROM dense)"""


def master_sql(missed_run: bool = False) -> str:
    """CTE list ending in ``master`` (the SQL twin of :func:`master_facts`)."""
    where = "WHERE NOT (day(d.snapshot_date) = 15 AND d.vehicle_type = 'P')" if missed_run else ""
    meas = ", ".join(f'd."{m}"' for m in D.MEASURES)
    return f"""{_delta_sql_body()},
od AS ({D.OFFICE_DIM_SQL}),
dist AS ({DISTRICT_SQL}),
master AS (
  SELECT strftime(d.snapshot_date + 1, '%d-%m-%Y') AS scrape_timestamp,
         strftime(d.snapshot_date, '%d-%m-%Y') AS timestamp,
         od.state, d.office AS RTO, od.office_code AS rto_number, d.vehicle_type,
         COALESCE(dist.district, 'Unknown') AS district, d.maker AS Maker, {meas}
  FROM delta d LEFT JOIN od ON od.office = d.office
  LEFT JOIN dist ON dist.office_key = upper(d.office)
  {where})"""


# --- files of the completeness / header checks ----------------------------------


def customer_offices(t: Tables) -> DataFrame:
    """Each customer as a report 'office': ``c_custkey, office, code, state``; code = region prefix + key."""
    c, n, r = t.customer, t.nation, t.region
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            "c_custkey",
            F.col("c_name").alias("office"),
            F.concat(F.upper(F.substring("r_name", 1, 2)), F.col("c_custkey").cast("string")).alias("code"),
            F.col("r_name").alias("state"),
        )
    )


CUSTOMER_OFFICES_SQL = (
    "SELECT c.c_custkey, c.c_name AS office, upper(substr(r.r_name, 1, 2)) || CAST(c.c_custkey AS VARCHAR) AS code, "
    "r.r_name AS state FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "JOIN region r ON n.n_regionkey = r.r_regionkey"
)


def manifest(t: Tables) -> DataFrame:
    """Expected files ``(pos, name)``: every customer office x both vehicle types, in key order."""
    co = customer_offices(t)
    vt = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(v).alias("v")) for i, v in enumerate(VEHICLE_TYPES)]))
    rows = co.select("c_custkey", "office", "code", vt.alias("vt"))
    return rows.select(
        (F.col("c_custkey") * 2 + F.col("vt.i")).alias("pos"),
        F.concat("office", F.lit(" - "), "code", F.lit("_"), F.col("vt.v"), F.lit(".xlsx")).alias("name"),
    )


MANIFEST_SQL = f"""manifest AS (
  SELECT c.c_custkey * 2 + unnest([0, 1]) AS pos,
         unnest([c.office || ' - ' || c.code || '_motor_car.xlsx', c.office || ' - ' || c.code || '_motor_cab.xlsx']) AS name
  FROM ({CUSTOMER_OFFICES_SQL}) c)"""


def landed_files(t: Tables) -> DataFrame:
    """Files that arrived: one per (customer, vehicle type) with orders, named by the order's shape.

    Status F -> ``motor_car``, O and P -> ``motor_cab``. P files carry a
    ``(copy)`` marker and an upper-case extension (exact name differs, code
    matches); 5-LOW orders land under a hash name (no office in the name);
    4-NOT SPECIFIED ones have an empty title. ``title`` is the report's first line.
    """
    o = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority")
    co = customer_offices(t)
    j = o.join(co, o.o_custkey == co.c_custkey)
    vt = F.when(F.col("o_orderstatus") == "F", "motor_car").otherwise("motor_cab")
    proper = F.concat("office", F.lit(" - "), "code", F.lit("_"), vt, F.lit(".xlsx"))
    copy = F.concat("office", F.lit(" (copy) - "), "code", F.lit("_"), vt, F.lit(".XLSX"))
    hashed = F.concat(F.md5(F.concat("office", F.lit("|"), vt)), F.lit("_"), vt, F.lit(".xlsx"))
    name = (
        F.when(F.col("o_orderpriority") == "5-LOW", hashed)
        .when(F.col("o_orderstatus") == "P", copy)
        .otherwise(proper)
    )
    title = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("")).otherwise(
        F.concat(
            F.when(F.col("o_orderstatus") == "O", F.lit("MAKER WISE FUEL DATA OF ")).otherwise(F.lit("Maker Wise Fuel Data of ")),
            "office", F.lit(" - "), "code", F.lit(" , "), "state", F.lit(" (2024)"),
        )
    )
    # One row per file; a name reached by several orders keeps its greatest title.
    return j.select(name.alias("name"), title.alias("title")).groupBy("name").agg(F.max("title").alias("title"))


LANDED_SQL = f"""landed AS (
  SELECT name, max(title) AS title FROM (SELECT
    CASE WHEN o.o_orderpriority = '5-LOW'
           THEN md5(c.office || '|' || (CASE WHEN o.o_orderstatus = 'F' THEN 'motor_car' ELSE 'motor_cab' END)) || '_' ||
                (CASE WHEN o.o_orderstatus = 'F' THEN 'motor_car' ELSE 'motor_cab' END) || '.xlsx'
         WHEN o.o_orderstatus = 'P'
           THEN c.office || ' (copy) - ' || c.code || '_' || (CASE WHEN o.o_orderstatus = 'F' THEN 'motor_car' ELSE 'motor_cab' END) || '.XLSX'
         ELSE c.office || ' - ' || c.code || '_' || (CASE WHEN o.o_orderstatus = 'F' THEN 'motor_car' ELSE 'motor_cab' END) || '.xlsx'
    END AS name,
    CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN ''
         ELSE (CASE WHEN o.o_orderstatus = 'O' THEN 'MAKER WISE FUEL DATA OF ' ELSE 'Maker Wise Fuel Data of ' END)
              || c.office || ' - ' || c.code || ' , ' || c.state || ' (2024)'
    END AS title
  FROM orders o JOIN ({CUSTOMER_OFFICES_SQL}) c ON o.o_custkey = c.c_custkey) GROUP BY name)"""
