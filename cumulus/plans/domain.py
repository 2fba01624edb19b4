"""The counter domain expressed over the driver tables.

The library works on any keyed table of month-to-date counters. The test
tables are an order schema, so each registered query maps the domain onto it:

=====================  ==========================================
domain                 driver tables
=====================  ==========================================
office (RTO)           ``nation.n_name``
office code            region prefix + nation key, e.g. ``AF0``
state                  ``region.r_name``
vehicle type           ``orders.o_orderstatus``
maker (OEM)            ``customer.c_mktsegment``
fuel (measure column)  ``orders.o_orderpriority`` (5 values)
data date              ``orders.o_orderdate`` (1995-01 .. 2001-08)
=====================  ==========================================

Daily counts per key are the ground truth; month-to-date snapshots are
derived from them exactly as a portal would publish them (one row per key
per snapshot day, from the key's first day in the month), so every delta has
a known answer: the daily count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..operators.snapshots import snapshot_index
from ..sources.tables import Tables

KEYS = ["office", "vehicle_type", "maker"]
# --- Fixed values of the test domain (the five order priorities) ----------
FUELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# --------------------------------------------------------------------------
MEASURES = [*FUELS, "TOTAL"]


def office_dim(t: Tables) -> DataFrame:
    """``(n_nationkey, office, office_code, state)`` from nation and region (tiny, scanned)."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey",
        F.col("n_name").alias("office"),
        F.concat(F.upper(F.substring("r_name", 1, 2)), F.col("n_nationkey").cast("string")).alias("office_code"),
        F.col("r_name").alias("state"),
    )


def order_facts(t: Tables) -> DataFrame:
    """One row per order with its domain attributes: ``day, office, vehicle_type, maker, fuel``."""
    o = t.orders.select(
        "o_custkey",
        F.to_date("o_orderdate").alias("day"),
        F.col("o_orderstatus").alias("vehicle_type"),
        F.col("o_orderpriority").alias("fuel"),
    )
    c = t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("maker"))
    n = t.nation.select("n_nationkey", F.col("n_name").alias("office"))
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .select("day", "office", "vehicle_type", "maker", "fuel")
    )


def daily_counts(t: Tables) -> DataFrame:
    """Daily counts per key, pivoted to one column per fuel (explicit values: no extra job)."""
    f = order_facts(t)
    return f.groupBy("day", *KEYS).agg(
        *[F.count_if(F.col("fuel") == p).cast("bigint").alias(p) for p in FUELS],
        F.count(F.lit(1)).cast("bigint").alias("TOTAL"),
    )


def run_calendar(t: Tables) -> DataFrame:
    """Snapshot days ``(day, month)``: every day with at least one order (one column scanned)."""
    day = F.to_date("o_orderdate")
    return t.orders.select(day.alias("day")).where(F.col("day").isNotNull()).distinct().withColumn("month", F.trunc("day", "month"))


def checked_calendar(t: Tables) -> DataFrame:
    """The run calendar, marked for broadcast after its size check (one row per day)."""
    return bounded_broadcast(run_calendar(t))


def mtd_snapshots(t: Tables, days: DataFrame | None = None, daily: DataFrame | None = None) -> DataFrame:
    """Month-to-date snapshots: ``snapshot_date, month, office, vehicle_type, maker, <measures>``.

    A key appears on every snapshot day of a month from its first active day
    in that month on. Plan: daily counts are hash-partitioned once by
    (key, month); one window gives the running sums and the key's next active
    day; a broadcast join against the (size-checked) calendar then repeats
    each running sum on the snapshot days up to the key's next active day.
    Window and broadcast join keep the (key, month) partitioning, so the delta
    that follows needs no shuffle. A (key, month) group holds at most 31 rows
    whatever the skew of keys in the raw data.
    """
    days = days if days is not None else checked_calendar(t)
    daily = daily if daily is not None else daily_counts(t)
    daily = daily.withColumn("month", F.trunc("day", "month")).repartition(*KEYS, "month")
    w = Window.partitionBy(*KEYS, "month").orderBy("day")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = daily.select(
        "day",
        "month",
        *KEYS,
        *[F.sum(F.col(f"`{m}`")).over(running).alias(m) for m in MEASURES],
        F.lead("day").over(w).alias("next_day"),
    )
    cal = days.select(F.col("day").alias("cal_day"), F.col("month").alias("cal_month"))
    covers = (
        (cum.month == cal.cal_month)
        & (cal.cal_day >= cum.day)
        & (cum.next_day.isNull() | (cal.cal_day < cum.next_day))
    )
    return cum.join(cal, covers).select(
        F.col("cal_day").alias("snapshot_date"), "month", *KEYS, *[F.col(f"`{m}`") for m in MEASURES]
    )


def snapshot_index_for(days: DataFrame) -> DataFrame:
    """Predecessor/successor per snapshot day, from the (already size-checked) calendar."""
    return snapshot_index(days.select(F.col("day").alias("snapshot_date")), "snapshot_date")


# SQL for the same derived relations, shared by the oracle queries.
def _q(name: str) -> str:
    return '"' + name + '"'


DAILY_SQL = (
    "SELECT CAST(o.o_orderdate AS DATE) AS day, n.n_name AS office, o.o_orderstatus AS vehicle_type, "
    "c.c_mktsegment AS maker, "
    + ", ".join(f"CAST(COUNT(*) FILTER (WHERE o.o_orderpriority = '{p}') AS BIGINT) AS {_q(p)}" for p in FUELS)
    + ", CAST(COUNT(*) AS BIGINT) AS \"TOTAL\" "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "GROUP BY 1, 2, 3, 4"
)

SNAPSHOT_SQL = f"""
daily AS ({DAILY_SQL}),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, date_trunc('month', CAST(o_orderdate AS DATE)) AS month
         FROM orders WHERE o_orderdate IS NOT NULL),
firsts AS (SELECT office, vehicle_type, maker, date_trunc('month', day) AS month, MIN(day) AS first_day
           FROM daily GROUP BY 1, 2, 3, 4),
grid AS (SELECT d.day, f.office, f.vehicle_type, f.maker, f.month
         FROM firsts f JOIN days d ON d.month = f.month AND d.day >= f.first_day),
snap AS (
  SELECT g.day AS snapshot_date, g.month, g.office, g.vehicle_type, g.maker,
         {", ".join(f"CAST(SUM(COALESCE(x.{_q(m)}, 0)) OVER w AS BIGINT) AS {_q(m)}" for m in MEASURES)}
  FROM grid g LEFT JOIN daily x
    ON x.day = g.day AND x.office = g.office AND x.vehicle_type = g.vehicle_type AND x.maker = g.maker
  WINDOW w AS (PARTITION BY g.office, g.vehicle_type, g.maker, g.month ORDER BY g.day
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

# The increments stated directly: on every snapshot day of a month from a key's first day on, the day's own count.
DENSE_SQL = f"""
daily AS MATERIALIZED ({DAILY_SQL}),
days AS MATERIALIZED (
  SELECT day, month, LAG(day) OVER (PARTITION BY month ORDER BY day) AS prev_date, LAG(day) OVER (ORDER BY day) AS chain_date
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, date_trunc('month', CAST(o_orderdate AS DATE)) AS month
        FROM orders WHERE o_orderdate IS NOT NULL)),
firsts AS (SELECT office, vehicle_type, maker, date_trunc('month', day) AS month, MIN(day) AS first_day FROM daily GROUP BY 1, 2, 3, 4),
grid AS MATERIALIZED (
  SELECT d.day AS snapshot_date, d.month, d.prev_date, d.chain_date, f.office, f.vehicle_type, f.maker
  FROM firsts f JOIN days d ON d.month = f.month WHERE d.day >= f.first_day),
dense AS MATERIALIZED (
  SELECT g.snapshot_date, g.month, g.prev_date, g.chain_date, g.office, g.vehicle_type, g.maker,
         {", ".join(f"COALESCE(x.{_q(m)}, 0) AS {_q(m)}" for m in MEASURES)}
  FROM grid g LEFT JOIN daily x
    ON x.day = g.snapshot_date AND x.office = g.office AND x.vehicle_type = g.vehicle_type AND x.maker = g.maker)"""

OFFICE_DIM_SQL = (
    "SELECT n.n_nationkey, n.n_name AS office, upper(substr(r.r_name, 1, 2)) || CAST(n.n_nationkey AS VARCHAR) AS office_code, "
    "r.r_name AS state FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"
)
