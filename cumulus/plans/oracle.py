"""Oracle SQL (DuckDB dialect) for every registered query with a SQL equivalent.

Written independently of the DataFrame code, straight from the semantics,
so the driver's side-by-side run checks one against the other.
"""

from __future__ import annotations

from .domain import DENSE_SQL, FUELS, MEASURES, SNAPSHOT_SQL

ORACLE: dict[str, str] = {}


def _q(n: str) -> str:
    return '"' + n + '"'


def _cols(prefix: str, names) -> str:
    return ", ".join(f"{prefix}{_q(m)}" for m in names)


_IDX = "idx AS (SELECT day AS snapshot_date, LAG(day) OVER (PARTITION BY month ORDER BY day) AS prev_date FROM days)"
_KEYS = "office, vehicle_type, maker"

ORACLE["delta_all_snapshots"] = f"""
WITH {DENSE_SQL}
SELECT snapshot_date, {_KEYS}, {_cols("", MEASURES)} FROM dense
"""

# Across a month boundary OLD is the whole of the month of the snapshot before.
ORACLE["delta_no_reset"] = f"""
WITH {DENSE_SQL},
month_sums AS (SELECT month, {_KEYS}, {", ".join(f"SUM({_q(m)}) AS {_q(m)}" for m in MEASURES)} FROM dense GROUP BY ALL)
SELECT d.snapshot_date, d.office, d.vehicle_type, d.maker,
       {", ".join(f"CAST(d.{_q(m)} - COALESCE(o.{_q(m)}, 0) AS BIGINT) AS {_q(m)}" for m in MEASURES)}
FROM dense d LEFT JOIN month_sums o
  ON o.month = CASE WHEN d.prev_date IS NULL THEN date_trunc('month', d.chain_date) END
 AND o.office = d.office AND o.vehicle_type = d.vehicle_type AND o.maker = d.maker
"""

ORACLE["delta_latest_pair"] = f"""
WITH {DENSE_SQL}
SELECT snapshot_date, {_KEYS}, {_cols("", MEASURES)} FROM dense WHERE snapshot_date = (SELECT MAX(day) FROM days)
"""

ORACLE["delta_month_reset"] = f"""
WITH {SNAPSHOT_SQL},
{_IDX},
month_firsts AS (SELECT snapshot_date FROM idx WHERE prev_date IS NULL),
delta AS (
  SELECT n.snapshot_date, n."TOTAL" - COALESCE(o."TOTAL", 0) AS total_delta
  FROM snap n JOIN idx i ON i.snapshot_date = n.snapshot_date
  LEFT JOIN snap o ON o.snapshot_date = i.prev_date AND o.office = n.office
                  AND o.vehicle_type = n.vehicle_type AND o.maker = n.maker
  WHERE n.snapshot_date IN (SELECT snapshot_date FROM month_firsts)),
d AS (SELECT snapshot_date, COUNT(*) AS keys_on_first_day, SUM(total_delta) AS delta_total FROM delta GROUP BY 1),
s AS (SELECT snapshot_date, SUM("TOTAL") AS snapshot_total FROM snap
      WHERE snapshot_date IN (SELECT snapshot_date FROM month_firsts) GROUP BY 1)
SELECT CAST(date_trunc('month', d.snapshot_date) AS DATE) AS month, d.snapshot_date AS first_day,
       CAST(d.keys_on_first_day AS BIGINT) AS keys_on_first_day,
       CAST(d.delta_total AS BIGINT) AS delta_total,
       CAST(s.snapshot_total AS BIGINT) AS snapshot_total
FROM d JOIN s ON s.snapshot_date = d.snapshot_date
"""

# The group's increment is the group's own count of the day; a month's first snapshot is copied row by row.
ORACLE["delta_dup_keys_compat"] = f"""
WITH {DENSE_SQL},
g AS (SELECT snapshot_date, office, vehicle_type, {", ".join(f"SUM({_q(m)}) AS {_q(m)}" for m in MEASURES)} FROM dense GROUP BY ALL)
SELECT d.snapshot_date, d.office, d.vehicle_type, d.maker,
       {", ".join(f"CAST(CASE WHEN d.prev_date IS NULL THEN d.{_q(m)} ELSE g.{_q(m)} END AS BIGINT) AS {_q(m)}" for m in MEASURES)}
FROM dense d JOIN g ON g.snapshot_date = d.snapshot_date AND g.office = d.office AND g.vehicle_type = d.vehicle_type
"""

# The newest snapshot with a predecessor in its month; a measure without an OLD column counts from the month's start.
ORACLE["delta_new_column"] = f"""
WITH {DENSE_SQL},
newest AS (SELECT MAX(day) AS day FROM days WHERE prev_date IS NOT NULL),
upto AS (
  SELECT {_KEYS}, SUM("5-LOW") AS low, SUM("1-URGENT" + "2-HIGH") AS high FROM dense
  WHERE month = (SELECT date_trunc('month', day) FROM newest) AND snapshot_date <= (SELECT day FROM newest) GROUP BY ALL)
SELECT d.snapshot_date, d.office, d.vehicle_type, d.maker, {_cols("d.", [m for m in MEASURES if m != "5-LOW"])},
       CAST(u.low AS BIGINT) AS "5-LOW", CAST(u.high AS BIGINT) AS "HIGH_OR_URGENT"
FROM dense d JOIN upto u ON u.office = d.office AND u.vehicle_type = d.vehicle_type AND u.maker = d.maker
WHERE d.snapshot_date = (SELECT day FROM newest)
"""

ORACLE["delta_null_keys"] = f"""
WITH {DENSE_SQL}
SELECT snapshot_date, office, vehicle_type, CASE WHEN maker <> 'HOUSEHOLD' THEN maker END AS maker, {_cols("", MEASURES)} FROM dense
"""

ORACLE["pivot_snapshot"] = (
    "SELECT CAST(o.o_orderdate AS DATE) AS day, n.n_name AS office, o.o_orderstatus AS vehicle_type, c.c_mktsegment AS maker, "
    + ", ".join(f"CAST(COUNT(*) FILTER (WHERE o.o_orderpriority = '{p}') AS BIGINT) AS {_q(p)}" for p in FUELS)
    + " FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"
    " GROUP BY 1, 2, 3, 4"
)

ORACLE["unpivot_measures"] = """
SELECT l_orderkey, l_linenumber, measure, value FROM (
  UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
  ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure VALUE value)
WHERE value <> 0
"""


def oracle_sql() -> dict[str, str]:
    from . import oracle_more, oracle_store  # noqa: F401  (add the remaining statements)

    return dict(ORACLE)
