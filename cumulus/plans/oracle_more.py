"""Oracle SQL for the queries in ``catalog_more`` (DuckDB dialect)."""

from __future__ import annotations

from . import domain as D
from . import fixtures as X
from .oracle import ORACLE

M = D.MEASURES
FUELS = D.FUELS
WS_TRIM = "'^\\s+|\\s+$'"
NUM = "'^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$'"


def _q(n: str) -> str:
    return '"' + n + '"'


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {WS_TRIM}, '', 'g')"


def _date(x: str) -> str:
    """Day-first lenient parse, same layouts and order as the library."""
    s = _strip(f"CAST({x} AS VARCHAR)")
    return (f"CAST(COALESCE(try_strptime({s}, '%d-%m-%Y'), try_strptime({s}, '%Y-%m-%d'), "
            f"try_strptime({s}, '%d/%m/%Y')) AS DATE)")


def _fy(d: str) -> str:
    y = f"year({d} - INTERVAL 3 MONTH)"
    return f"CAST({y} AS VARCHAR) || '-' || lpad(CAST(({y} + 1) % 100 AS VARCHAR), 2, '0')"


def _qtr(d: str) -> str:
    return f"'Q' || CAST(quarter({d} - INTERVAL 3 MONTH) AS VARCHAR)"


# --- dims ----------------------------------------------------------------------------

ORACLE["dim_enrich"] = f"""
WITH {X.master_sql()},
geo AS ({X.GEO_SQL}), mk AS ({X.MAKER_SQL})
SELECT {_date('m.timestamp')} AS Date, m.RTO, m.vehicle_type, m.Maker, g.cluster, g.city, g.AO, mk.maker_short, m."TOTAL"
FROM master m LEFT JOIN geo g ON g.RTO = m.RTO LEFT JOIN mk ON mk.OEM = m.Maker
"""

ORACLE["dim_default_unknown"] = f"""
WITH {X.master_sql()}
SELECT RTO, district, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM("TOTAL") AS BIGINT) AS total
FROM master GROUP BY 1, 2
"""

ORACLE["dim_unmapped"] = f"""
WITH {X.master_sql()},
geo AS ({X.GEO_SQL})
SELECT DISTINCT m.RTO FROM master m WHERE m.RTO IS NOT NULL AND m.RTO NOT IN (SELECT RTO FROM geo)
"""

# --- mart ----------------------------------------------------------------------------

_FUEL_COLS = ", ".join(_q(f) for f in FUELS)
MART_SQL = f"""
{X.master_sql()},
geo AS ({X.GEO_SQL}), mk AS ({X.MAKER_SQL}), fuel AS ({X.FUEL_SQL}), zone AS ({X.ZONE_SQL}),
w AS (SELECT CAST(strptime(timestamp, '%d-%m-%Y') AS DATE) AS Date, state, RTO, rto_number, vehicle_type,
             Maker AS OEM, {_FUEL_COLS} FROM master),
long AS (UNPIVOT w ON {_FUEL_COLS} INTO NAME FuelType VALUE vol),
g AS (SELECT l.Date, l.state, l.RTO, l.rto_number, l.vehicle_type, l.OEM, f.FuelGroup, SUM(l.vol) AS vol
      FROM long l JOIN fuel f ON f.FuelType = l.FuelType WHERE l.vol <> 0 GROUP BY ALL),
mart AS (
  SELECT g.Date, g.state, geo.cluster, geo.city, geo.AO, g.RTO, g.rto_number, g.vehicle_type, g.OEM, mk.maker_short,
         g.FuelGroup, CAST(g.vol AS BIGINT) AS "Regn Vol", zone.Zone,
         {_fy('g.Date')} AS FY, monthname(g.Date) AS month, {_qtr('g.Date')} AS Qtr
  FROM g LEFT JOIN geo ON geo.RTO = g.RTO LEFT JOIN mk ON mk.OEM = g.OEM LEFT JOIN zone ON zone.state = g.state)"""

ORACLE["fuel_group_mart"] = f"WITH {MART_SQL} SELECT * FROM mart"

ORACLE["month_to_date"] = f"""WITH {MART_SQL}
SELECT * FROM mart
WHERE Date >= CAST(date_trunc('month', (SELECT max(Date) FROM mart)) AS DATE) AND Date <= (SELECT max(Date) FROM mart)"""

ORACLE["fiscal_calendar"] = f"""
SELECT day, {_fy('day')} AS FY, {_qtr('day')} AS Qtr, monthname(day) AS month
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate IS NOT NULL)
"""

_UNMAPPED = [f for f in FUELS if f not in {m for ms in X.FUEL_GROUPS_T.values() for m in ms}]
_MAPPED = [f for f in FUELS if f not in _UNMAPPED]
_ALL = " + ".join(f"COALESCE(m.{_q(f)}, 0)" for f in FUELS)
_MAP = " + ".join(f"COALESCE(m.{_q(f)}, 0)" for f in _MAPPED)
_UNM = " + ".join(f"COALESCE(m.{_q(f)}, 0)" for f in _UNMAPPED)
_UNM_ROWS = " + ".join(f"CASE WHEN COALESCE(m.{_q(f)}, 0) <> 0 THEN 1 ELSE 0 END" for f in _UNMAPPED)
ORACLE["mart_audit"] = f"""
WITH {X.master_sql()},
geo AS ({X.GEO_SQL}),
a AS (SELECT SUM({_ALL}) AS initial_total, SUM({_MAP}) AS mapped, SUM({_UNM_ROWS}) AS unmapped_rows,
             SUM({_UNM}) AS unmapped_volume, COUNT(*) FILTER (WHERE geo.AO IS NULL) AS missing_ao
      FROM master m LEFT JOIN geo ON geo.RTO = m.RTO)
SELECT CAST(initial_total AS BIGINT) AS initial_total, CAST(initial_total AS BIGINT) AS after_melt_total,
       CAST(mapped AS BIGINT) AS after_fuel_map_total, CAST(mapped AS BIGINT) AS final_total,
       CAST(unmapped_rows AS BIGINT) AS unmapped_fuel_rows, CAST(unmapped_volume AS BIGINT) AS unmapped_fuel_volume,
       CAST(missing_ao AS BIGINT) AS missing_ao_rows,
       CASE WHEN abs(initial_total - mapped) <= 0.01 THEN 'preserved' WHEN initial_total - mapped > 0 THEN 'loss' ELSE 'gain' END AS verdict
FROM a
"""

# --- reconciliation --------------------------------------------------------------------

_SUMS = ", ".join(f"CAST(SUM({_q(m)}) AS BIGINT) AS {_q(m)}" for m in M)
# ``od`` (office dim) and ``dist`` (district dim) come from the master CTEs.
# A month's last snapshot is the sum of the month's daily counts.
_CUM_SQL = f"""
month_end AS (SELECT MAX(day) AS last_day, CAST(month AS DATE) AS month FROM days GROUP BY month),
cum AS (SELECT CAST(s.month AS DATE) AS month, s.office AS RTO, s.maker AS Maker, od.state, od.office_code AS rto_number,
               COALESCE(dist.district, 'Unknown') AS district, {", ".join(f"s.{_q(m)}" for m in M)}
        FROM dense s LEFT JOIN od ON od.office = s.office LEFT JOIN dist ON dist.office_key = upper(s.office)),
cum_s AS (SELECT month, RTO, Maker, state, rto_number, district, {_SUMS} FROM cum GROUP BY ALL)"""


def _facts_summary(name: str, src: str) -> str:
    return (f"{name} AS (SELECT CAST(date_trunc('month', {_date('timestamp')}) AS DATE) AS month, RTO, Maker, state, "
            f"rto_number, district, {_SUMS} FROM {src} WHERE {_date('timestamp')} IS NOT NULL GROUP BY ALL)")


_RECON = f"""
{X.master_sql(missed_run=True)},
{_CUM_SQL},
{_facts_summary('fact_s', 'master')},
recon AS (
  SELECT month, RTO, Maker, state, rto_number, district, {", ".join(f"CAST(SUM({_q(m)}) AS BIGINT) AS {_q(m)}" for m in M)}
  FROM (SELECT * FROM cum_s UNION ALL
        SELECT month, RTO, Maker, state, rto_number, district, {", ".join(f"-{_q(m)}" for m in M)} FROM fact_s)
  GROUP BY ALL)"""

ORACLE["reconcile_full_outer"] = f"WITH {_RECON} SELECT * FROM recon"

_FILLERS = f"""
fillers AS (
  SELECT strftime(me.last_day + 1, '%d-%m-%Y') AS scrape_timestamp, strftime(me.last_day, '%d-%m-%Y') AS timestamp,
         r.state, r.RTO, r.rto_number, 'motor_car' AS vehicle_type, r.district, r.Maker,
         {", ".join(f"r.{_q(m)}" for m in M)}, 'filler' AS row_source
  FROM recon r JOIN month_end me ON me.month = r.month)"""

ORACLE["filler_rows"] = f"WITH {_RECON}, {_FILLERS} SELECT * FROM fillers"

ORACLE["corrected_master"] = f"""
WITH {_RECON}, {_FILLERS},
fixed AS (SELECT scrape_timestamp, timestamp, state, RTO, rto_number, vehicle_type, district, Maker, {", ".join(_q(m) for m in M)}
          FROM master UNION ALL
          SELECT scrape_timestamp, timestamp, state, RTO, rto_number, vehicle_type, district, Maker, {", ".join(_q(m) for m in M)}
          FROM fillers),
{_facts_summary('corr_s', 'fixed')},
chk AS (SELECT month, RTO, Maker, state, rto_number, district, SUM(t) AS t FROM
          (SELECT month, RTO, Maker, state, rto_number, district, "TOTAL" AS t FROM cum_s UNION ALL
           SELECT month, RTO, Maker, state, rto_number, district, -"TOTAL" FROM corr_s) GROUP BY ALL),
pm AS (SELECT month, CAST(COUNT(*) AS BIGINT) AS keys, CAST(COUNT(*) FILTER (WHERE t <> 0) AS BIGINT) AS keys_unbalanced
       FROM chk GROUP BY 1),
tot AS (SELECT month, CAST(SUM("TOTAL") AS BIGINT) AS corrected_total FROM corr_s GROUP BY 1)
SELECT pm.month, pm.keys, pm.keys_unbalanced, tot.corrected_total FROM pm JOIN tot ON tot.month = pm.month
"""

ORACLE["corrected_master_rows"] = f"""
WITH {_RECON}, {_FILLERS}
SELECT scrape_timestamp, timestamp, state, RTO, rto_number, vehicle_type, district, Maker, {", ".join(_q(m) for m in M)},
       CAST(NULL AS VARCHAR) AS row_source
FROM master
UNION ALL
SELECT * FROM fillers
"""

ORACLE["monthly_summary"] = f"""
WITH {X.master_sql()},
p AS (SELECT *, {_date('timestamp')} AS d FROM master)
SELECT RTO, Maker, state, rto_number, district, {_SUMS}
FROM p WHERE d >= CAST(date_trunc('month', (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)) AS DATE)
GROUP BY ALL
"""

# --- master append ------------------------------------------------------------------------

_EV = "ev AS (SELECT CAST(ts AS DATE) AS day, ts, event_type, value, user_id FROM events), last AS (SELECT max(day) AS d FROM ev)"


def _counts(where: str) -> str:
    return (f"SELECT strftime(day + 1, '%d-%m-%Y') AS scrape_timestamp, event_type, CAST(COUNT(*) AS BIGINT) AS events, "
            f"CAST(SUM(round(value * 100)) AS BIGINT) AS value_cents FROM ev WHERE {where} GROUP BY day, event_type")


ORACLE["replace_and_append"] = f"""
WITH {_EV},
master AS ({_counts('day < (SELECT d FROM last)')} UNION ALL {_counts('day = (SELECT d FROM last) AND hour(ts) < 12')}),
replay AS ({_counts('day = (SELECT d FROM last)')})
SELECT * FROM master
WHERE NOT COALESCE({_date('scrape_timestamp')} = (SELECT d FROM last) + 1, false)
UNION ALL SELECT * FROM replay
"""

ORACLE["align_union"] = f"""
WITH {_EV}
SELECT day, event_type, CAST(COUNT(*) AS BIGINT) AS events, CAST(NULL AS BIGINT) AS users
FROM ev WHERE day < (SELECT d FROM last) GROUP BY 1, 2
UNION ALL
SELECT day, event_type, CAST(COUNT(*) AS BIGINT) AS events, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS users
FROM ev WHERE day = (SELECT d FROM last) GROUP BY 1, 2
"""

# --- scalars ---------------------------------------------------------------------------------

ORACLE["numeric_coerce"] = f"""
SELECT doc_id,
       CAST(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '' AND regexp_matches(x, {NUM}))) AS BIGINT) AS n_numeric,
       CAST(COALESCE(list_sum(list_transform(
            list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '' AND regexp_matches(x, {NUM})),
            lambda x: COALESCE(TRY_CAST(trunc(TRY_CAST(x AS DOUBLE)) AS BIGINT), 0))), 0) AS BIGINT) AS numeric_sum
FROM documents
"""


def _flag(col: str) -> str:
    return f"COALESCE(max(CASE WHEN regexp_matches(CAST({col} AS VARCHAR), {NUM}) THEN 1 ELSE 0 END), 0) = 1"


ORACLE["numeric_columns"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_flag(c)} AS is_numeric FROM documents" for c in ["doc_id", "text", "lang", "source", "n_chars"]
)

ORACLE["mixed_dates"] = f"""
WITH o AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderkey % 3 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%d-%m-%Y')
              WHEN o_orderkey % 3 = 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
              ELSE CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
         END AS date_text
  FROM orders)
SELECT o_orderkey, date_text, {_date('date_text')} AS parsed, {_date('date_text')} = order_date AS ok FROM o
"""

_ODD = f"""odd AS (
  SELECT unnest([c.office || ' - ' || c.code || '_motor_car.xlsx', c.office || ' - ' || c.code || '_motor_cab.xlsx',
                 c.office || ' - ' || c.code || '.xlsx', lower(c.office || ' - ' || c.code || '_motor_car.xlsx'),
                 c.office || ' - ' || c.code || '_motor_car_extra.csv']) AS name
  FROM ({X.CUSTOMER_OFFICES_SQL}) c)"""

_FN = "'^(.+?)\\s*-\\s*([A-Z]+[0-9]+)'"
ORACLE["file_name_parse"] = f"""
WITH {_ODD},
b AS (SELECT name, replace(replace(name, '.xlsx', ''), '.csv', '') AS base FROM odd),
p AS (SELECT name, base, split_part(base, '_', 1) AS first FROM b),
r AS (SELECT name, regexp_matches(first, {_FN}) AS ok,
             {_strip(f"regexp_extract(first, {_FN}, 1)")} AS office,
             {_strip(f"regexp_extract(first, {_FN}, 2)")} AS code,
             CASE WHEN strpos(base, '_') > 0 THEN substr(base, strpos(base, '_') + 1) ELSE 'unknown' END AS vt
      FROM p)
SELECT name,
       CASE WHEN ok THEN CASE upper(substr(code, 1, 2)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.STATE_BY_PREFIX_T.items())} ELSE 'Unknown' END END AS state,
       CASE WHEN ok THEN office END AS office, CASE WHEN ok THEN code END AS office_code,
       CASE WHEN ok THEN vt END AS vehicle_type
FROM r
"""


def _norm(x: str) -> str:
    """Drop parenthesised parts, collapse whitespace, trim, lower-case."""
    no_parens = f"regexp_replace({x}, '\\([^)]*\\)', ' ', 'g')"
    collapsed = f"regexp_replace({no_parens}, '\\s+', ' ', 'g')"
    return f"lower({_strip(collapsed)})"


def _base(x: str) -> str:
    b = f"regexp_extract({x}, '([^/\\\\]*)$', 1)"
    return (f"(CASE WHEN regexp_matches({b}, '\\.[^.]*$') AND NOT regexp_matches({b}, '^\\.[^.]*$') "
            f"THEN regexp_replace({b}, '\\.[^.]*$', '') ELSE {b} END)")


def _split(b: str) -> tuple[str, str]:
    """(office_part, vehicle_type) of a base name, as in the library."""
    office = (f"(CASE WHEN suffix(lower({b}), '_motor_car') THEN substr({b}, 1, length({b}) - 10) "
              f"WHEN suffix(lower({b}), '_motor_cab') THEN substr({b}, 1, length({b}) - 10) "
              f"WHEN strpos({b}, '_') > 0 THEN regexp_replace({b}, '_[^_]*$', '') ELSE {b} END)")
    vt = (f"(CASE WHEN suffix(lower({b}), '_motor_car') THEN 'motor_car' "
          f"WHEN suffix(lower({b}), '_motor_cab') THEN 'motor_cab' "
          f"WHEN strpos({b}, '_') > 0 THEN regexp_extract({b}, '_([^_]*)$', 1) ELSE '' END)")
    return office, vt


def _identity_cte(src: str) -> str:
    office, vt = _split("b")
    return f"""ident AS (
  SELECT name, regexp_extract(upper(b), '([A-Z]{{2}}[0-9]+)', 1) AS office_code, lower({vt}) AS vehicle_type,
         {_norm(office)} AS office_norm
  FROM (SELECT name, {_base('name')} AS b FROM {src}))"""


ORACLE["file_identity"] = f"WITH {X.LANDED_SQL}, {_identity_cte('landed')} SELECT * FROM ident"

ORACLE["normalize_text"] = f"SELECT doc_id, {_norm('text')} AS normalized FROM documents"

_TITLE_PREFIX = "'^maker\\s+wise\\s+fuel\\s+data\\s+of\\s+'"
_TAIL = "'\\s*,\\s*[^,]+(\\([^)]*\\))?\\s*$'"


def _office_from_title(x: str) -> str:
    t1 = _strip(f"regexp_replace(COALESCE({x}, ''), {_TITLE_PREFIX}, '', 'i')")
    return _strip(f"regexp_replace({t1}, {_TAIL}, '')")


ORACLE["title_to_office"] = f"WITH {X.LANDED_SQL} SELECT name, title, {_office_from_title('title')} AS office FROM landed"

_AUDIT = f"""
{X.LANDED_SQL},
f AS (SELECT '/landing/' || name AS path, title FROM landed),
g AS (SELECT path, {_base('path')} AS b, {_office_from_title('title')} AS office FROM f),
h AS (SELECT path, b, office, {_split('b')[0]} AS office_part,
             CASE WHEN lower({_strip('b')}) = 'reporttable' AND {_split('b')[1]} = '' THEN 'motor_car' ELSE {_split('b')[1]} END AS vt
      FROM g),
audit AS (
  SELECT path,
         CASE WHEN office = '' THEN 'no_header' WHEN {_norm('office_part')} = {_norm('office')} THEN 'ok' ELSE 'mismatch' END AS status,
         office, vt FROM h),
res AS (
  SELECT path, status, CASE WHEN status = 'mismatch' THEN office END AS header_office,
         CASE WHEN status = 'mismatch' THEN regexp_extract(path, '^(.*[/\\\\])', 1) ||
              regexp_replace(office || '_' || vt, '^_+|_+$', '', 'g') ||
              COALESCE(NULLIF(regexp_extract(path, '(\\.[^./\\\\]*)$', 1), ''), '.xlsx') END AS new_path
  FROM audit)"""

ORACLE["header_name_audit"] = f"WITH {_AUDIT} SELECT * FROM res"
ORACLE["header_status_counts"] = f"WITH {_AUDIT} SELECT status, CAST(COUNT(*) AS BIGINT) AS files FROM res GROUP BY 1"
ORACLE["keep_last_per_target"] = f"""WITH {_AUDIT},
t AS (SELECT COALESCE(new_path, path) AS target, path, status,
             row_number() OVER (PARTITION BY COALESCE(new_path, path) ORDER BY (new_path IS NOT NULL) DESC, path DESC) AS rn FROM res)
SELECT target, path AS winner, status FROM t WHERE rn = 1"""

# --- completeness ------------------------------------------------------------------------------

_MISSING = f"""
{X.LANDED_SQL},
{X.MANIFEST_SQL},
present AS (SELECT name FROM landed WHERE suffix(lower(name), '.xlsx')),
{_identity_cte('present').replace('ident AS', 'pident AS', 1)},
findex AS (SELECT DISTINCT office_code, vehicle_type FROM pident
           WHERE office_code <> '' AND vehicle_type IN ('motor_car', 'motor_cab')),
{_identity_cte('manifest').replace('ident AS', 'mident AS', 1)},
missing AS (
  SELECT m.pos, m.name, i.office_code, i.vehicle_type
  FROM manifest m JOIN mident i ON i.name = m.name
  WHERE lower(m.name) NOT IN (SELECT lower(name) FROM present)
    AND NOT EXISTS (SELECT 1 FROM findex x WHERE x.office_code = i.office_code AND x.vehicle_type = i.vehicle_type
                    AND i.office_code <> '')),
tgt AS (
  SELECT upper(office_code) AS rto_code, vehicle_type,
         CASE upper(substr(office_code, 1, 2)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.STATE_BY_PREFIX_T.items())} END AS state,
         name AS expected_filename, pos,
         row_number() OVER (PARTITION BY upper(office_code), vehicle_type ORDER BY pos) AS rn
  FROM missing WHERE office_code <> '' AND vehicle_type IN ('motor_car', 'motor_cab')),
targets AS (SELECT rto_code, vehicle_type, state, expected_filename, pos FROM tgt WHERE state IS NOT NULL AND rn = 1)"""

ORACLE["missing_files"] = f"WITH {_MISSING} SELECT * FROM missing"
ORACLE["rescrape_targets"] = f"WITH {_MISSING} SELECT * FROM targets"
ORACLE["missing_by_state"] = f"WITH {_MISSING} SELECT state, CAST(COUNT(*) AS BIGINT) AS targets FROM targets GROUP BY 1"
ORACLE["completeness_totals"] = f"""WITH {_MISSING}
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM manifest) AS expected,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM present) AS present,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM missing) AS missing"""
ORACLE["code_lookup"] = f"""WITH {_MISSING},
entries AS (SELECT office || ' - ' || code AS entry FROM ({X.CUSTOMER_OFFICES_SQL}))
SELECT t.rto_code, t.vehicle_type, e.entry FROM targets t JOIN entries e
  ON regexp_matches(e.entry, t.rto_code || '([^0-9]|$)', 'i')"""

# --- snapshot choice, filters ---------------------------------------------------------------

ORACLE["latest_snapshot"] = """
WITH ev AS (SELECT CAST(ts AS DATE) AS day, ts, event_type FROM events),
files AS (
  SELECT strftime(day, '%Y-%m-%d') || '.csv' AS name, CAST(day AS TIMESTAMP) AS name_ts, max(ts) AS mtime FROM ev GROUP BY day
  UNION ALL
  SELECT 'export_' || event_type || '.csv', CAST(NULL AS TIMESTAMP), max(ts) FROM ev GROUP BY event_type),
a AS (SELECT 'dated_first' AS rule, 1 AS rank, name FROM files
      ORDER BY (name_ts IS NOT NULL) DESC, COALESCE(name_ts, mtime) DESC, name DESC LIMIT 1),
b AS (SELECT 'mixed' AS rule, CAST(row_number() OVER (ORDER BY COALESCE(name_ts, mtime) DESC, name DESC) AS INTEGER) AS rank, name
      FROM files QUALIFY rank <= 2)
SELECT * FROM a UNION ALL SELECT * FROM b
"""

ORACLE["maker_whitelist"] = f"""
SELECT c.c_mktsegment AS maker, CAST(COUNT(*) AS BIGINT) AS orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE {_strip('c.c_mktsegment')} IN ({", ".join(repr(m) for m in X.MAKER_WHITELIST_T)})
GROUP BY 1
"""

ORACLE["drop_blank_rows"] = f"""
SELECT doc_id, line_no, label FROM (
  SELECT doc_id, CAST(line_no - 1 AS INTEGER) AS line_no, {_strip('line')} AS label
  FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no,
               unnest(string_split(text, chr(10))) AS line FROM documents))
WHERE label IS NOT NULL AND label NOT IN ('Maker', 'TOTAL', '')
"""


# --- report ingest ----------------------------------------------------------------------------

from ..functions.scalars import STATE_BY_CODE_PREFIX  # noqa: E402

_LATEST = f"""{D.SNAPSHOT_SQL},
last AS (SELECT d FROM (SELECT day AS d, LEAD(day) OVER (PARTITION BY month ORDER BY day) AS nxt FROM days) WHERE nxt IS NULL),
od AS ({D.OFFICE_DIM_SQL}),
dist AS ({X.DISTRICT_SQL})"""

ORACLE["ingest_reports"] = f"""
WITH {_LATEST}
SELECT strftime(l.d + 1, '%d-%m-%Y') AS scrape_timestamp, strftime(l.d, '%d-%m-%Y') AS timestamp,
       CASE upper(substr(od.office_code, 1, 2)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_BY_CODE_PREFIX.items())}
            ELSE 'Unknown' END AS state,
       replace(s.office, '_', ' ') AS rto, od.office_code AS rto_number, s.vehicle_type,
       COALESCE(dist.district, 'Unknown') AS district, s.maker AS Maker, {", ".join(f"CAST(s.{_q(m)} AS BIGINT) AS {_q(m)}" for m in M)}
FROM snap s JOIN last l ON s.snapshot_date = l.d JOIN od ON od.office = s.office
LEFT JOIN dist ON dist.office_key = upper(replace(s.office, '_', ' '))
WHERE od.state <> 'MIDDLE EAST' AND s.maker IN ({", ".join(repr(m) for m in X.MAKER_WHITELIST_T)})
"""

ORACLE["ingest_quarantine"] = f"""
WITH {_LATEST}
SELECT DISTINCT strftime(l.d + 1, '%Y-%m-%d') || '_RTO_Files/' || replace(s.office, '_', ' ') || '_' || s.vehicle_type || '.csv'
       AS file_name, 'file name does not parse' AS error
FROM snap s JOIN last l ON s.snapshot_date = l.d JOIN od ON od.office = s.office
WHERE od.state = 'MIDDLE EAST'
"""

# X1 replayed incrementally must equal the one-pass batch result.
ORACLE["incremental_ingest"] = ORACLE["delta_all_snapshots"]

ORACLE["replace_partition_replay"] = """
SELECT strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS scrape_date, event_type, CAST(COUNT(*) AS BIGINT) AS events,
       CAST(SUM(round(value * 100)) AS BIGINT) AS value_cents
FROM events GROUP BY CAST(ts AS DATE), event_type
"""
