"""Oracle SQL of the queries over stored tables and files."""

from __future__ import annotations

from . import domain as D
from . import fixtures as X
from .oracle import ORACLE, _q
from .oracle_more import _RECON
from .report_export import EXTRA_FUEL

M = D.MEASURES

# The first run books what is missing, the second finds nothing; the replay of the first is its second version.
ORACLE["correction_ledger"] = f"""
WITH {_RECON},
first_run AS (
  SELECT month, COUNT(*) AS keys, COUNT(*) FILTER (WHERE {" OR ".join(f"{_q(m)} <> 0" for m in M)}) AS keys_changed,
         SUM("TOTAL") AS corrected_total FROM recon GROUP BY month)
SELECT month AS corrected_month, CAST(month + INTERVAL 1 MONTH + INTERVAL 2 DAY AS DATE) AS run_date, CAST(keys AS BIGINT) AS keys,
       CAST(keys_changed AS BIGINT) AS keys_changed, CAST(corrected_total AS BIGINT) AS corrected_total,
       CAST(0 AS BIGINT) AS rows_outside_month, CAST(2 AS BIGINT) AS versions FROM first_run
UNION ALL
SELECT month, CAST(month + INTERVAL 1 MONTH + INTERVAL 9 DAY AS DATE), CAST(keys AS BIGINT), 0, 0, 0, 1 FROM first_run
"""

ORACLE["ledger_balance"] = f"""
WITH {X.master_sql()}
SELECT month, CAST(n AS BIGINT) AS booked, CAST(n AS BIGINT) AS figure
FROM (SELECT CAST(date_trunc('month', strptime(timestamp, '%d-%m-%Y')) AS DATE) AS month, SUM("TOTAL") AS n FROM master GROUP BY 1)
"""

ORACLE["ingest_open_measures"] = f"""
WITH {D.DENSE_SQL},
ends AS (SELECT month, MAX(day) AS last_day FROM days GROUP BY month),
od AS ({D.OFFICE_DIM_SQL}),
figure AS (
  SELECT e.last_day AS "Date", s.office, s.vehicle_type, s.maker, {", ".join(f"SUM(s.{_q(m)}) AS {_q(m)}" for m in M)},
         CASE WHEN month(any_value(e.last_day) + 1) % 2 = 1 THEN SUM(s."2-HIGH") ELSE 0 END AS {_q(EXTRA_FUEL)}
  FROM dense s JOIN ends e ON e.month = s.month JOIN od ON od.office = s.office
  WHERE od.state <> 'MIDDLE EAST' AND s.maker IN ({", ".join(repr(m) for m in X.MAKER_WHITELIST_T)}) GROUP BY ALL),
long AS (
  {" UNION ALL ".join(f"""SELECT "Date", office, vehicle_type, maker, '{g}' AS "FuelGroup", {" + ".join(_q(f) for f in fs)} AS vol FROM figure"""
                      for g, fs in {**X.FUEL_GROUPS_T, "Trial": [EXTRA_FUEL]}.items())})
SELECT "Date", "FuelGroup", CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(vol) AS BIGINT) AS volume FROM long WHERE vol <> 0 GROUP BY ALL
"""

_ALL = " + ".join(_q(f) for f in D.FUELS)
ORACLE["mart_audit_measured"] = f"""
WITH {X.master_sql()},
geo AS ({X.GEO_SQL}),
a AS (
  SELECT SUM({_ALL}) AS everything, SUM("4-NOT SPECIFIED") AS unmapped, COUNT(*) FILTER (WHERE "4-NOT SPECIFIED" <> 0) AS unmapped_rows,
         COUNT(*) FILTER (WHERE RTO NOT IN (SELECT RTO FROM geo)) AS without_ao,
         SUM({_ALL}) FILTER (WHERE RTO = (SELECT MIN(RTO) FROM geo)) AS again FROM master),
cases AS (
  SELECT 'all_mapped' AS "case", everything AS mapped, everything AS final, 0 AS gone_rows, 0 AS gone, 'preserved' AS verdict, a.* FROM a UNION ALL
  SELECT 'unmapped_fuel', everything - unmapped, everything - unmapped, unmapped_rows, unmapped, 'loss', a.* FROM a UNION ALL
  SELECT 'office_twice', everything, everything + again, 0, 0, 'gain', a.* FROM a)
SELECT "case", CAST(everything AS BIGINT) AS initial_total, CAST(everything AS BIGINT) AS after_melt_total,
       CAST(mapped AS BIGINT) AS after_fuel_map_total, CAST(final AS BIGINT) AS final_total, CAST(final AS BIGINT) AS written_total,
       CAST(gone_rows AS BIGINT) AS unmapped_fuel_rows, CAST(gone AS BIGINT) AS unmapped_fuel_volume,
       CAST(without_ao AS BIGINT) AS missing_ao_rows, verdict FROM cases
"""

ORACLE["mart_period_refresh"] = ORACLE["month_to_date"]

_RUNNING = ", ".join(f"CAST(SUM({_q(m)}) OVER w AS BIGINT) AS {_q(m)}" for m in M)
ORACLE["snapshot_csv_drift"] = f"""
WITH {D.DENSE_SQL},
cum AS (
  SELECT snapshot_date, office AS RTO, vehicle_type, maker AS Maker, {_RUNNING} FROM dense
  WINDOW w AS (PARTITION BY office, vehicle_type, maker, month ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING))
SELECT snapshot_date, RTO, vehicle_type, Maker, {", ".join(_q(m) for m in M if m not in ("5-LOW", "TOTAL"))},
       CASE WHEN month(snapshot_date) % 3 <> 2 THEN "5-LOW" END AS "5-LOW", "TOTAL",
       CASE WHEN month(snapshot_date) % 3 = 2 THEN "2-HIGH" END AS {_q(EXTRA_FUEL)} FROM cum
"""

ORACLE["snapshot_catalogue"] = f"""
WITH {D.DENSE_SQL},
ends AS (
  SELECT e.last_day, COUNT(DISTINCT (s.office, s.vehicle_type, s.maker)) AS n
  FROM dense s JOIN (SELECT month, MAX(day) AS last_day FROM days GROUP BY month) e ON e.month = s.month GROUP BY 1),
newest AS (SELECT last_day, n, row_number() OVER (ORDER BY last_day DESC) AS r FROM ends)
SELECT 'dated_first' AS policy, CAST(r AS BIGINT) AS rank, strftime(last_day, '%Y-%m-%d') || '.csv' AS name, CAST(last_day AS DATE) AS name_date,
       CAST(n AS BIGINT) AS n_rows FROM newest WHERE r <= 2
UNION ALL SELECT 'mixed', 1, 'export.csv', CAST(NULL AS DATE), 0
UNION ALL SELECT 'mixed', 2, strftime(last_day, '%Y-%m-%d') || '.csv', CAST(last_day AS DATE), CAST(n AS BIGINT) FROM newest WHERE r = 1
"""

_LAYOUTS = ["%-d-%-m-%Y", "%d.%m.%Y", "%Y/%m/%d", "%-d %B %Y", "%b %-d, %Y", "%d-%b-%Y", "%Y-%m-%d %H:%M:%S", "%d/%m/%Y"]
ORACLE["mixed_date_layouts"] = f"""
SELECT o_orderkey, CASE o_orderkey % {len(_LAYOUTS)} {" ".join(f"WHEN {k} THEN strftime(CAST(o_orderdate AS DATE), '{f}')" for k, f in enumerate(_LAYOUTS))} END AS date_text,
       CAST(o_orderdate AS DATE) AS parsed, o_orderdate IS NOT NULL AS ok FROM orders
"""
