"""DuckDB SQL equivalents of :mod:`civicmart.plans.bindings` (driver views are registered
under the table names). Written from the operators' definitions, not from the Spark plans:
the week spine uses ``generate_series``, membership uses ``EXISTS``, last-wins uses
``QUALIFY``/``arg_max``."""

from __future__ import annotations

from ..functions.geo import state_plane_sql
from . import round_trips
from .bindings import CATALOG_MINUTES, EXPENSE_TEXT, REVENUE_TEXT, SERVICE_DAYS, SERVICE_TEXT
from .finance import EXPENSES_NUMERIC_COLS, REVENUE_NUMERIC_COLS
from .flex_notes import IGNORED_QUESTIONS
from .service_requests import FIELD_MAPPING

WEEK_OF = "CAST({d} AS DATE) + CAST(6 - dayofweek(CAST({d} AS DATE)) AS INTEGER)"

EVENTS_FOLDER = """
  SELECT event_id AS folderrsn,
         CASE WHEN event_type = 'view' THEN 'DS' WHEN event_type = 'purchase' THEN 'EX'
              WHEN event_type = 'click' THEN 'RW' ELSE upper(event_type) END AS foldertype,
         user_id AS subcode,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS statuscode,
         ts AS indate,
         ts + to_hours(CAST(floor(value) AS BIGINT)) AS issuedate
  FROM events"""



def rules(rows: dict[str, dict[str, tuple[int, ...]]]) -> str:
    """Rules by permit type as a table: (foldertype, kind, code); a type's codes of a kind are barred,
    and a row whose code of that kind is unknown is barred too."""
    cells = [f"('{t}', '{kind}', {code})" for t, kinds in rows.items() for kind, codes in kinds.items() for code in (*codes, "NULL")]
    return f"rule (foldertype, kind, code) AS (VALUES {', '.join(cells)})"


def unbarred(alias: str, **kinds: str) -> str:
    """Rows of a listed type that no rule bars; ``kinds``: kind of code -> the row's column."""
    bars = " OR ".join(f"(rule.kind = '{kind}' AND {alias}.{column} IS NOT DISTINCT FROM rule.code)" for kind, column in kinds.items())
    return (
        f"EXISTS (SELECT 1 FROM rule WHERE rule.foldertype = {alias}.foldertype) "
        f"AND NOT EXISTS (SELECT 1 FROM rule WHERE rule.foldertype = {alias}.foldertype AND ({bars}))"
    )


# Types a query counts, and what bars a row of each.
APPS_RULES = {"DS": {"status": (9, 58, 99)}, "EX": {"status": (58, 99), "sub": (8, 46)}, "RW": {"status": (58, 99), "sub": (8, 46)}}
LINE_RULES = {"DS": {"other": ()}, "EX": {"other": ()}, "RW": {"sub": (6, 7)}}
EVENT_RULES = {"DS": {"other": ()}, "EX": {"other": ()}, "RW": {"sub": (8, 46)}}

PART_FOLDER = """
  SELECT CASE p_type WHEN 'MEDIUM' THEN 'DS' WHEN 'LARGE' THEN 'EX' WHEN 'SMALL' THEN 'RW' ELSE p_type END AS foldertype,
         p_size AS statuscode, p_brand AS foldername
  FROM part"""

# Parts by status: 1 to 25 are active; a small part of the first brand family is not counted.
ACTIVE_PARTS = f"""
  SELECT foldertype, COUNT(*) AS activepermits
  FROM ({PART_FOLDER}) AS part_folder SEMI JOIN range(1, 26) AS active(statuscode) USING (statuscode)
  WHERE list_contains(['DS', 'EX', 'RW'], foldertype) AND (foldertype = 'RW' AND (foldername IS NULL OR starts_with(foldername, 'Brand#1'))) IS NOT TRUE
  GROUP BY foldertype"""


def _sql() -> dict[str, str]:
    lat, lon = state_plane_sql("3000000.0 + 100.0 * o_custkey", "9900000.0 + 10.0 * o_orderkey")
    q: dict[str, str] = {}

    q["applications_received"] = f"""
WITH {rules(APPS_RULES)}, folder AS (SELECT * FROM ({EVENTS_FOLDER}) AS e WHERE e.indate >= DATE '2024-01-03')
SELECT foldertype, subcode, CAST(indate + INTERVAL 12 HOUR AS DATE) AS day, COUNT(*) AS issuedrowpermits
FROM folder WHERE {unbarred("folder", status="statuscode", sub="subcode")}
GROUP BY 1, 2, 3"""

    q["issued_permits"] = f"""
WITH {rules(LINE_RULES)}, folder AS (
  SELECT CASE l_returnflag WHEN 'N' THEN 'DS' WHEN 'A' THEN 'EX' WHEN 'R' THEN 'RW' END AS foldertype,
         l_linenumber AS subcode, l_shipdate AS issuedate
  FROM lineitem WHERE l_shipdate >= DATE '1996-01-01')
SELECT foldertype, subcode, CAST(issuedate + INTERVAL 12 HOUR AS DATE) AS day, COUNT(*) AS issuedrowpermits
FROM folder WHERE {unbarred("folder", sub="subcode")}
GROUP BY 1, 2, 3"""

    q["active_permits"] = ACTIVE_PARTS

    q["review_time"] = """
WITH urgent AS (
  SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
per_order AS (
  SELECT l_orderkey,
    list(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS comments,
    list({'s': l_shipdate, 'e': l_shipdate + to_days(CAST(floor(l_quantity) AS INTEGER))}) FILTER (WHERE l_linenumber = 1) AS firsts,
    list(l_shipdate) FILTER (WHERE l_linenumber = 2) AS seconds
  FROM lineitem SEMI JOIN urgent ON l_orderkey = o_orderkey GROUP BY l_orderkey),
with_comment AS (SELECT l_orderkey, firsts, seconds, unnest(comments) AS dept_comments FROM per_order),
with_first AS (SELECT l_orderkey, seconds, dept_comments, unnest(coalesce(firsts, [NULL])) AS f FROM with_comment),
with_second AS (SELECT l_orderkey, dept_comments, f, unnest(coalesce(seconds, [NULL])) AS extend FROM with_first)
SELECT o_custkey AS customfoldernumber, o_orderkey AS folderrsn, o_orderdate AS indate, CAST(NULL AS TIMESTAMP) AS issuedate,
       f.s AS webappstart, f.e AS webappend, extend, dept_comments
FROM with_second JOIN urgent ON l_orderkey = o_orderkey"""

    q["ex_permits_issued"] = """
SELECT format('{}-{}', year(o_orderdate), o_orderkey) AS permit_id, o_custkey AS subcode,
       (SELECT max(c_mktsegment) FROM customer WHERE c_custkey = o_custkey) AS subdesc,
       'ORD-' || o_orderkey AS foldername,
       strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') AS indate_text,
       strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') AS issuedate_text
FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' AND year(o_orderdate) >= 1996"""

    q["count_by_date"] = """
SELECT CAST(ts AS DATE) AS date, COUNT(*) AS count_permits FROM events WHERE ts IS NOT NULL GROUP BY 1"""

    q["weekly_resample"] = f"""
WITH w AS (
  SELECT l_suppkey, {WEEK_OF.format(d='l_shipdate')} AS week,
         SUM(l_quantity) AS l_quantity, COUNT(*) AS n
  FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2),
s AS (SELECT l_suppkey, MIN(week) AS lo, MAX(week) AS hi FROM w GROUP BY 1),
sp AS (
  SELECT l_suppkey, CAST(g AS DATE) AS week
  FROM (SELECT l_suppkey, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS g FROM s))
SELECT sp.l_suppkey, sp.week, COALESCE(w.l_quantity, 0) AS l_quantity, CAST(COALESCE(w.n, 0) AS BIGINT) AS n
FROM sp LEFT JOIN w ON sp.l_suppkey = w.l_suppkey AND sp.week = w.week"""

    q["weekly_permit_summary"] = f"""
WITH folder AS ({EVENTS_FOLDER}),
apps AS (
  WITH {rules(APPS_RULES)}, dated AS (SELECT * FROM folder WHERE indate >= DATE '2024-01-03')
  SELECT foldertype AS series, CAST(indate + INTERVAL 12 HOUR AS DATE) AS day, COUNT(*) AS n
  FROM dated WHERE {unbarred("dated", status="statuscode", sub="subcode")} GROUP BY 1, 2),
iss AS (
  WITH {rules(EVENT_RULES)}, dated AS (SELECT * FROM folder WHERE issuedate >= DATE '2024-01-05')
  SELECT foldertype AS series, CAST(issuedate + INTERVAL 12 HOUR AS DATE) AS day, COUNT(*) AS n
  FROM dated WHERE {unbarred("dated", sub="subcode")} GROUP BY 1, 2),
com AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events WHERE event_type = 'signup' AND ts IS NOT NULL GROUP BY 1),
ext AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events
        WHERE event_type = 'error' AND ts IS NOT NULL GROUP BY 1),
res AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events WHERE event_type = 'view' AND ts IS NOT NULL GROUP BY 1),
long AS (
  SELECT 'app' AS measure, series, day, n FROM apps
  UNION ALL SELECT 'iss', series, day, n FROM iss
  UNION ALL SELECT 'com', 'cnt', day, n FROM com
  UNION ALL SELECT 'ext', 'cnt', day, n FROM ext
  UNION ALL SELECT 'res', 'cnt', day, n FROM res),
wk AS (SELECT measure, series, {WEEK_OF.format(d='day')} AS week, n FROM long),
spans AS (SELECT measure, MIN(week) AS lo, MAX(week) AS hi FROM wk GROUP BY 1),
weeks AS (
  SELECT DISTINCT CAST(g AS DATE) AS week
  FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS g FROM spans)),
sums AS (
  SELECT week,
    SUM(n) FILTER (WHERE measure = 'ext') AS ext,
    SUM(n) FILTER (WHERE measure = 'app' AND series = 'DS') AS app_ds,
    SUM(n) FILTER (WHERE measure = 'com') AS com,
    SUM(n) FILTER (WHERE measure = 'res') AS res,
    SUM(n) FILTER (WHERE measure = 'iss' AND series = 'DS') AS iss_ds,
    SUM(n) FILTER (WHERE measure = 'app' AND series = 'EX') AS app_ex,
    SUM(n) FILTER (WHERE measure = 'iss' AND series = 'EX') AS iss_ex,
    SUM(n) FILTER (WHERE measure = 'app' AND series = 'RW') AS app_rw,
    SUM(n) FILTER (WHERE measure = 'iss' AND series = 'RW') AS iss_rw
  FROM wk GROUP BY week)
SELECT strftime(weeks.week, '%Y-%m-%d') || 'T00:00:00.000' AS date,
  CAST(COALESCE(ext, 0) AS DOUBLE) AS extension_requests,
  CAST(COALESCE(app_ds, 0) AS DOUBLE) + CAST(COALESCE(com, 0) AS DOUBLE) + CAST(COALESCE(res, 0) AS DOUBLE)
    AS ds_applications_received,
  CAST(COALESCE(iss_ds, 0) AS DOUBLE) AS ds_permits_issued,
  CAST(COALESCE(app_ex, 0) AS DOUBLE) AS ex_applications_received,
  CAST(COALESCE(iss_ex, 0) AS DOUBLE) AS ex_permits_issued,
  CAST(COALESCE(app_rw, 0) AS DOUBLE) AS rw_applications_received,
  CAST(COALESCE(iss_rw, 0) AS DOUBLE) AS rw_permits_issued
FROM weeks LEFT JOIN sums ON weeks.week = sums.week"""

    q["weekly_permit_summary_extracts"] = q["weekly_permit_summary"]

    q["rotate_categories"] = f"""
WITH active AS ({ACTIVE_PARTS})
SELECT AVG(CAST(activepermits AS DOUBLE)) FILTER (WHERE foldertype = 'DS') AS ds,
       AVG(CAST(activepermits AS DOUBLE)) FILTER (WHERE foldertype = 'EX') AS ex,
       AVG(CAST(activepermits AS DOUBLE)) FILTER (WHERE foldertype = 'RW') AS rw
FROM active"""

    q["fiscal_fields"] = """
SELECT o_orderkey,
  CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS BIGINT) AS fiscal_year,
  CAST(CASE WHEN month(o_orderdate) >= 10 THEN month(o_orderdate) - 9 ELSE month(o_orderdate) + 3 END AS BIGINT)
    AS fiscal_month,
  strftime(o_orderdate, '%b') AS month_name,
  strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS order_time
FROM orders"""

    q["utc_to_local"] = """
SELECT event_id, strftime(timezone('America/Chicago', ts AT TIME ZONE 'UTC'), '%Y-%m-%dT%H:%M:%S') AS local_time
FROM events"""

    q["state_plane_to_wgs84"] = f"""
WITH p AS (SELECT o_orderkey, {lat} AS lat, {lon} AS lon FROM orders)
SELECT o_orderkey, lat AS latitude, lon AS longitude,
  CASE WHEN lat IS NOT NULL AND lon IS NOT NULL
       THEN 'POINT (' || CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR) || ')' END AS location
FROM p"""

    q["row_identifier"] = """
SELECT o_orderkey,
  coalesce(CAST(year(o_orderdate) AS VARCHAR), 'None') || coalesce(o_orderstatus, 'None')
    || coalesce(CAST(o_custkey AS VARCHAR), 'None') AS row_identifier
FROM orders"""

    q["membership_flag"] = """
SELECT c.c_custkey,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
          AND o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'P') AS has_urgent_pending
FROM customer c"""

    q["attach_row_counts"] = """
SELECT s.s_suppkey, CASE WHEN s.s_acctbal >= 0 THEN 'dataset' ELSE 'chart' END AS type,
  CASE WHEN s.s_acctbal >= 0 THEN (SELECT COUNT(*) FROM lineitem l WHERE l.l_suppkey = s.s_suppkey) END AS row_count
FROM supplier s"""

    last = lambda role: f"CASE WHEN count(*) FILTER (WHERE role = '{role}') = 0 THEN '' ELSE arg_max_null(text, turn) FILTER (WHERE role = '{role}') END"
    q["pick_metadata"] = f"""
SELECT conv_id, {last("user")} AS "user", {last("assistant")} AS assistant, {last("system")} AS system
FROM conversations GROUP BY conv_id"""

    q["join_tags"] = """
SELECT o_custkey, coalesce(string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority), '') AS tags
FROM orders GROUP BY o_custkey"""

    q["json_field"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"

    q["upsert"] = """
WITH c AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey FROM customer),
target AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM c),
inc AS (
  SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal, c_mktsegment, 1 AS seq FROM c WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal * 3 AS c_acctbal, c_mktsegment, 2 AS seq FROM c
  WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 10),
latest AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM inc
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.c_custkey IS NOT DISTINCT FROM t.c_custkey)
UNION ALL
SELECT * FROM latest"""

    q["exclude_values"] = """
SELECT doc_id, nullif(lang, 'fr') AS flex_question, source AS flex_answer
FROM documents WHERE nullif(lang, 'fr') IS NULL OR nullif(lang, 'fr') NOT IN ('de')"""

    q["catalog_scope"] = """
WITH a AS (
  SELECT CASE WHEN n_chars > 10000 THEN CAST(doc_id AS VARCHAR) || ':draft' ELSE CAST(doc_id AS VARCHAR) END AS id,
         source AS owner_id, nullif(lang, 'fr') AS category
  FROM documents)
SELECT id, owner_id, category FROM a
WHERE (coalesce(owner_id, '') = 'src3' OR coalesce(category, '') = 'en') AND NOT contains(id, ':')"""

    q["blank_to_null"] = """
WITH t AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN '' ELSE CAST(p_size AS VARCHAR) END AS size_text FROM part)
SELECT p_partkey, size_text, CAST(nullif(size_text, '') AS DECIMAL(18, 2)) AS size_amount FROM t"""

    q["map_fields"] = "SELECT c_custkey AS customer_id, c_name AS name, CAST(NULL AS VARCHAR) AS fax FROM customer"

    q["slice_reports"] = """
WITH f AS (
  SELECT o_orderkey, o_orderpriority AS department,
         CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS BIGINT) AS fiscal_year,
         last_day(o_orderdate) AS month_end
  FROM orders),
grid AS (
  SELECT * FROM (VALUES ('1-URGENT', 1998, DATE '1997-12-31'), ('1-URGENT', 1998, DATE '1998-01-31'),
                        ('2-HIGH', 1998, DATE '1997-12-31'), ('2-HIGH', 1998, DATE '1998-01-31'))
           AS g(department, fiscal_year, month_end))
SELECT f.* FROM f
WHERE EXISTS (SELECT 1 FROM grid g WHERE g.department = f.department AND g.fiscal_year = f.fiscal_year
              AND g.month_end = f.month_end)"""

    q["to_records"] = """
SELECT c_custkey AS customer_id,
  CAST(to_json(struct_pack(customer_id := c_custkey, name := c_name, fax := CAST(NULL AS VARCHAR))) AS VARCHAR) AS record
FROM customer"""

    x = "CASE WHEN o_orderstatus <> 'P' THEN 3000000.0 + 100.0 * o_custkey END"
    y = "CASE WHEN o_orderstatus <> 'P' THEN 9900000.0 + 10.0 * o_orderkey END"
    slat, slon = state_plane_sql(x, y)
    nul = "CAST(NULL AS VARCHAR)"
    passed = ",\n  ".join(f"{sql} AS {FIELD_MAPPING[c]}" for c, sql in SERVICE_TEXT.items())
    dates = ",\n  ".join(
        f"strftime(o_orderdate + INTERVAL {n} DAY, '%Y-%m-%dT%H:%M:%S') AS {FIELD_MAPPING[c]}" for c, n in SERVICE_DAYS.items()
    )
    q["service_requests"] = f"""
WITH sr AS (SELECT *, {slat} AS lat, {slon} AS lon FROM orders)
SELECT 'SR-' || o_orderkey AS service_request_sr_number, o_orderpriority AS department, o_orderstatus AS sr_status,
  {passed},
  {dates},
  CAST({x} AS DOUBLE) AS state_plane_x_coordinate, CAST({y} AS DOUBLE) AS state_plane_y_coordinate,
  CASE WHEN lat IS NOT NULL AND lon IS NOT NULL
       THEN 'POINT (' || CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR) || ')' END AS location,
  CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS BIGINT) AS fiscal_year
FROM sr"""

    def report(given: dict[str, str], numeric: list[str], keys: list[str]) -> str:
        inputs = ", ".join(f"{sql} AS {c}" for c, sql in given.items() if c != "department")
        out = ", ".join(f"nullif({c}, '') AS {c}" if c in numeric else c for c in given)
        rid = " || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in keys)
        return f"""
WITH r AS (
  SELECT {inputs},
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(l_suppkey AS INTEGER) AS department,
         strftime(last_day(l_shipdate), '%Y-%m-%d') || '_' || CAST(l_suppkey AS VARCHAR) || '.csv' AS source_file
  FROM lineitem),
d AS (
  SELECT *, CAST(year + CASE WHEN month >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
         CAST(CASE WHEN month >= 10 THEN month - 9 ELSE month + 3 END AS INTEGER) AS fiscal_month,
         strftime(make_date(2022, month, 1), '%b') AS month_name
  FROM r)
SELECT {out}, year, month, month_name, fiscal_year, fiscal_month, {rid} AS row_identifier, source_file
FROM d"""

    q["finance_rows"] = report(EXPENSE_TEXT, EXPENSES_NUMERIC_COLS, ["fiscal_year", "fiscal_month", "fund", "department", "unit", "object_code"])
    q["revenue_rows"] = report(
        REVENUE_TEXT, REVENUE_NUMERIC_COLS,
        ["fiscal_year", "fiscal_month", "fund", "department", "unit", "revenue_source_category_code", "revenue_source_code"],
    )

    denied = [t.replace("'", "''") for t in IGNORED_QUESTIONS]
    q["flex_notes"] = f"""
SELECT conv_id * 1000 + turn AS flex_note_id, 'SR-' || conv_id AS service_request_number, turn AS flex_notes_definition_id,
  conv_id AS service_request_id, nullif(role, 'system') AS flex_question, text AS flex_answer
FROM conversations
WHERE NOT (role = 'assistant' AND conv_id % 2 = 0 AND CASE WHEN turn % 2 = 1 THEN '{denied[0]}' ELSE '{denied[-1]}' END IN ({", ".join(f"'{t}'" for t in denied)}))"""

    q["month_window"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-02-01'"""

    q["report_name_fields"] = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber <> 1 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
  CASE WHEN l_linenumber <> 1 THEN CAST(month(l_shipdate) AS INTEGER) END AS month,
  CASE WHEN l_linenumber <> 1 THEN CAST(l_suppkey % 10000 AS INTEGER) END AS department
FROM lineitem"""

    q["snake_columns"] = "SELECT c_custkey AS customer_key, c_mktsegment AS market_segment, c_acctbal AS account_balance FROM customer"

    q["nan_to_null"] = "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events"

    local = "strftime(timezone('America/Chicago', (TIMESTAMP '2020-01-01' + to_minutes(s.n_chars * {n})) AT TIME ZONE 'UTC'), '%Y-%m-%dT%H:%M:%S')"
    times = ", ".join(
        f'{local.format(n=n)} AS "{c}"' if c != "publication_date" else f"CASE WHEN s.lang <> 'fr' THEN {local.format(n=n)} END AS {c}"
        for c, n in CATALOG_MINUTES.items()
    )
    q["catalog_table"] = f"""
WITH a AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source, lang, n_chars, nullif(lang, 'fr') AS category,
         CASE WHEN n_chars > 5000 THEN 'dataset' ELSE 'story' END AS type
  FROM documents),
scoped AS (
  SELECT * FROM a WHERE (coalesce(source, '') = 'src3' OR coalesce(category, '') = 'en') AND NOT contains(id, ':')),
pub AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM labels WHERE quality = 1),
cnt AS (SELECT CAST(doc_id AS VARCHAR) AS id, COUNT(*) AS n FROM labels GROUP BY 1)
SELECT s.id, s.source AS name, s.lang AS description, {nul} AS attribution, s.type,
  {times}, s.n_chars AS download_count,
  CAST(trunc(s.n_chars / 100) AS BIGINT) AS page_views_last_week,
  CAST(trunc(s.n_chars / 10) AS BIGINT) AS page_views_last_month,
  s.n_chars AS page_views_total,
  CASE WHEN p.id IS NOT NULL THEN '{"https://public.example/d/"}' ELSE '{"https://internal.example/d/"}' END || s.id AS dataset_url,
  p.id IS NOT NULL AS is_public,
  upper(s.source) AS owner_display_name,
  s.lang || ', ' || s.source AS tags,
  '' AS automation_method, '' AS automation_method_other, '' AS update_frequency, '' AS spatial_information,
  s.source AS department_name, s.lang AS program_name, '' AS strategic_area,
  CASE WHEN s.type = 'dataset' THEN coalesce(c.n, 0) END AS row_count
FROM scoped s LEFT JOIN pub p ON s.id = p.id LEFT JOIN cnt c ON s.id = c.id"""

    q["pivot_sum"] = """
WITH folder AS (
  SELECT CASE l_returnflag WHEN 'N' THEN 'DS' WHEN 'A' THEN 'EX' WHEN 'R' THEN 'RW' END AS foldertype,
         l_linenumber AS subcode, l_shipdate AS issuedate
  FROM lineitem),
daily AS (
  SELECT foldertype, subcode, CAST(issuedate + INTERVAL 12 HOUR AS DATE) AS day, COUNT(*) AS n
  FROM folder
  WHERE (foldertype IN ('EX', 'DS') AND issuedate >= DATE '1996-01-01' AND issuedate IS NOT NULL)
     OR (foldertype IN ('RW') AND subcode NOT IN (6, 7) AND issuedate >= DATE '1996-01-01' AND issuedate IS NOT NULL)
  GROUP BY 1, 2, 3)
SELECT day,
  CAST(SUM(n) FILTER (WHERE foldertype = 'DS') AS BIGINT) AS ds,
  CAST(SUM(n) FILTER (WHERE foldertype = 'EX') AS BIGINT) AS ex,
  CAST(SUM(n) FILTER (WHERE foldertype = 'RW') AS BIGINT) AS rw
FROM daily GROUP BY day"""

    q["sheet_day_counts"] = """
SELECT CAST(strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS DATE) AS date,
       COUNT(*) AS count_permits
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"""

    q["last_wins"] = """
SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"""

    q["active_permit_snapshot"] = """
WITH c AS (
  SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || 'T00:00:00.000' AS published_date,
         CASE o_orderstatus WHEN 'F' THEN 'DS' WHEN 'O' THEN 'EX' ELSE 'RW' END AS foldertype,
         COUNT(*) AS activepermits
  FROM orders GROUP BY 1, 2)
SELECT AVG(CAST(activepermits AS DOUBLE)) FILTER (WHERE foldertype = 'DS') AS ds,
       AVG(CAST(activepermits AS DOUBLE)) FILTER (WHERE foldertype = 'EX') AS ex,
       AVG(CAST(activepermits AS DOUBLE)) FILTER (WHERE foldertype = 'RW') AS rw,
       published_date
FROM c GROUP BY published_date"""

    value = lambda key: f"list_filter(pairs, lambda p: p.key = coalesce({key}, 'none'))[-1].value"
    q["pairs_to_map"] = f"""
WITH d AS (
  SELECT doc_id, lang, source, [
    {{'key': coalesce(lang, 'none'), 'value': 'first'}},
    {{'key': coalesce(source, 'none'), 'value': lang}},
    {{'key': coalesce(CASE WHEN n_chars % 2 = 0 THEN lang ELSE source END, 'none'), 'value': CAST(n_chars AS VARCHAR)}},
    {{'key': coalesce(CASE WHEN n_chars % 3 = 0 THEN lang END, 'none'), 'value': 'last'}}] AS pairs
  FROM documents)
SELECT doc_id, {value("lang")} AS lang_value, {value("source")} AS source_value, {value("CAST(NULL AS VARCHAR)")} AS none_value FROM d"""

    return q


ORACLE_SQL: dict[str, str] = _sql() | round_trips.ORACLE_SQL
