"""DuckDB SQL for the queries of `catalog`, written from the rules and the tables alone."""

from __future__ import annotations

_SPACE = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_MONTHS = "['GENNAIO', 'FEBBRAIO', 'MARZO', 'APRILE', 'MAGGIO', 'GIUGNO', 'LUGLIO', 'AGOSTO', 'SETTEMBRE', 'OTTOBRE', 'NOVEMBRE', 'DICEMBRE']"

_PAIRS = """
WITH ev AS (
  SELECT event_id, user_id, ts::DATE AS d, date_trunc('minute', ts) AS m,
    CASE WHEN event_type IN ('click', 'signup') THEN 'E' WHEN event_type IN ('view', 'purchase') THEN 'U' END AS kind FROM events),
k AS (SELECT *, CASE WHEN kind = 'U' AND event_id % 17 = 0 THEN d::TIMESTAMP + INTERVAL 1 DAY ELSE m END AS t FROM ev WHERE kind IS NOT NULL AND user_id % 11 <> 0),
w AS (SELECT *, lag(kind) OVER x AS before, lead(kind) OVER x AS after, lead(t) OVER x AS next FROM k WINDOW x AS (PARTITION BY user_id, d ORDER BY m, event_id)),
p AS (SELECT user_id, d, m, event_id, CASE WHEN kind = 'E' THEN t END AS entry_ts, CASE WHEN kind = 'U' THEN t WHEN after = 'U' THEN next END AS exit_ts
  FROM w WHERE kind = 'E' OR before IS NULL OR before = 'U'),
q AS (SELECT user_id || '-' || strftime(d, '%Y%m') AS doc_id, day(d)::INTEGER AS day, (row_number() OVER (PARTITION BY user_id, d ORDER BY m, event_id) - 1)::INTEGER AS pair_index,
  entry_ts::TIMESTAMP AS entry_ts, exit_ts::TIMESTAMP AS exit_ts, date_diff('minute', entry_ts, exit_ts) AS minutes FROM p)
"""

_DAYS = """
WITH dd AS (SELECT user_id, ts::DATE AS d, sum(event_id)::BIGINT % 600 AS worked, (count(*) * 7) % 500 AS f FROM events GROUP BY ALL),
doc AS (SELECT user_id, user_id || '-' || strftime(min(d), '%Y%m') AS doc_id, sum(worked)::BIGINT AS worked,
  sum(worked)::BIGINT + CASE WHEN user_id % 5 = 0 THEN 30 ELSE 0 END AS total FROM dd GROUP BY user_id, strftime(d, '%Y%m')),
ok AS (SELECT * FROM doc WHERE user_id % 11 <> 0)
"""

_TREE = """
WITH RECURSIVE tree AS (
  SELECT 'r' || r_regionkey AS id, 'root' AS parent_id, r_name AS name, true AS folder, NULL::VARCHAR AS mime, false AS trashed FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name, true, NULL::VARCHAR, false FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_mktsegment || ' ' || c_name || CASE WHEN c_custkey % 13 = 0 THEN ' Propaganda' ELSE '' END || CASE WHEN c_custkey % 4 = 1 THEN '.Zip' ELSE '' END,
    false, CASE c_custkey % 4 WHEN 0 THEN 'zip' WHEN 1 THEN 'text' ELSE 'pdf' END, c_custkey % 10 = 9 FROM customer),
f AS (SELECT *, CASE WHEN replace(replace(lower(name), '_', ' '), '-', ' ') IN ('asia', 'nation 3', 'nation 17') THEN replace(replace(lower(name), '_', ' '), '-', ' ') END AS reason FROM tree WHERE folder AND NOT trashed),
walk AS (
  SELECT id AS employee_id, id AS folder_id, name AS folder_name, 0 AS level, reason FROM f WHERE parent_id = 'root'
  UNION ALL SELECT w.employee_id, f.id, f.name, w.level + 1, f.reason FROM walk w JOIN f ON f.parent_id = w.folder_id WHERE w.reason IS NULL),
items AS (
  SELECT employee_id, CASE WHEN why IS NULL THEN 'included' ELSE 'skipped' END AS section, id AS file_id, CASE WHEN mime <> 'pdf' THEN 'zip' END AS container, why AS reason
  FROM (SELECT w.employee_id, t.id, t.mime, CASE WHEN contains(lower(t.name), 'asia') THEN 'asia' WHEN contains(lower(t.name), 'nation 3') THEN 'nation 3'
      WHEN contains(lower(t.name), 'nation 17') THEN 'nation 17' WHEN contains(lower(t.name), 'paga') THEN 'paga' END AS why
    FROM walk w JOIN tree t ON t.parent_id = w.folder_id WHERE w.reason IS NULL AND NOT t.folder AND NOT t.trashed AND (t.mime IN ('pdf', 'zip') OR lower(t.name) LIKE '%.zip')))
"""

_FILES = """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 50 <> 0 THEN (o_orderkey % 40)::VARCHAR END AS file_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)),
"""

#: Files by key: of each id the first place and the last name; base copies beyond the first stay as they are.
_FOLD = """
base AS (SELECT CASE WHEN o_custkey % 7 <> 0 THEN 'id:' || o_custkey ELSE 'name:' || lower(c_name) END AS key, 'skipped' AS section, 0 AS step, o_custkey AS seq, o_orderkey AS pos, file_id,
  row_number() OVER (PARTITION BY o_custkey, file_id ORDER BY o_orderkey) AS occ, o_orderkey AS name FROM o JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O'),
every AS (SELECT * FROM base UNION ALL SELECT * FROM new),
fold AS (SELECT key, section, min((step, seq, pos)) AS place, arg_max(file_id, (step, seq, pos)) AS file_id, arg_max(name, (step, seq, pos)) AS name
  FROM (SELECT *, CASE WHEN file_id IS NULL THEN '#' || step || '/' || seq || '/' || pos ELSE '=' || file_id END AS one FROM every) GROUP BY key, section, one, CASE WHEN file_id IS NULL THEN 1 ELSE occ END)
"""

_NEW = f"""{_FILES}
new AS (SELECT CASE WHEN o_custkey % 10 = 0 AND o_custkey % 20 = 0 THEN 'id:x' || o_custkey WHEN o_custkey % 7 <> 0 THEN 'id:' || o_custkey ELSE 'name:' || lower(c_name) END AS key,
  CASE WHEN o_orderstatus = 'F' THEN 'included' ELSE 'skipped' END AS section, 1 AS step, o_custkey AS seq, o_orderkey AS pos, file_id, 1 AS occ, o_orderkey AS name
  FROM o JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'O'),
{_FOLD}"""

_OLDER = f"""{_FILES}
new AS (SELECT CASE WHEN o_custkey % 7 <> 0 THEN 'id:' || o_custkey ELSE 'name:' || lower(c_name) END AS key,
  CASE WHEN o_orderstatus = 'F' THEN 'included' ELSE 'skipped' END AS section, 1 AS step, o_orderkey AS seq, 0 AS pos, file_id, 1 AS occ, o_orderkey AS name
  FROM o JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'O'),
{_FOLD}"""

_ITEM_ROWS = "SELECT key, section, row_number() OVER (PARTITION BY key, section ORDER BY place) AS place, file_id, name::VARCHAR AS file_name FROM fold"

_PEOPLE = """,
people AS (SELECT CASE WHEN c_custkey % 7 <> 0 THEN 'id:' || c_custkey ELSE 'name:' || lower(c_name) END AS key, c_name AS employee, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey::VARCHAR END AS employee_id FROM customer
  UNION ALL {more}),
n AS (SELECT key, count(*) FILTER (section = 'included') AS included, count(*) FILTER (section = 'skipped') AS skipped,
  md5(string_agg(name::VARCHAR, ',' ORDER BY place) FILTER (section = 'included')) AS im, md5(string_agg(name::VARCHAR, ',' ORDER BY place) FILTER (section = 'skipped')) AS sm FROM fold GROUP BY key)
"""
_OPENED = "SELECT 'id:x' || c_custkey, 'New ' || upper(c_name), 'x' || c_custkey FROM customer WHERE c_custkey % 20 = 0"
_NONE = "SELECT NULL, NULL, NULL WHERE false"
_JSON = """SELECT employee, employee_id, coalesce(included, 0)::BIGINT AS n_included, coalesce(skipped, 0)::BIGINT AS n_skipped, coalesce(im, md5('')) AS included_md5, coalesce(sm, md5('')) AS skipped_md5
FROM people LEFT JOIN n USING (key)"""


def _squeezed(x: str) -> str:
    return f"array_to_string(list_filter(string_split_regex({x}, '{_SPACE}'), lambda t: t <> ''), ' ')"


def _safe(x: str) -> str:
    return f"""coalesce(nullif(substr(translate(regexp_replace({x}, '^{_SPACE}|{_SPACE}$', '', 'g'), '\\/:*?"<>|', '_________'), 1, 120), ''), 'unnamed')"""


def _hours(minutes: str) -> str:
    return f"round(sign({minutes}) * ((abs({minutes}) // 60) + (abs({minutes}) % 60) / 60.0), 9)"


_V = "(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * (l_quantity + l_discount))"
_TAG_ID = "md5(page_id::VARCHAR)"
_TAG_NAME = f"CASE WHEN page_id % 6 <> 0 THEN url ELSE {_TAG_ID} END"
_NAME_SQL = f"""CASE WHEN c_custkey % 9 = 0 THEN 'É' ELSE '' END || translate(upper(c_name), '#0123456789', ' ABCDEFGHIJ')"""

SQL: dict[str, str] = {
    "hours_per_user_day": _PAIRS + "SELECT doc_id, day, sum(coalesce(minutes, 0))::BIGINT AS minutes, count(*) AS n_pairs, count(minutes) AS n_closed FROM q GROUP BY doc_id, day",
    "event_pairs": _PAIRS + "SELECT doc_id, day, pair_index, entry_ts, exit_ts FROM q",
    "event_pairs_rows": _PAIRS.replace(" AND user_id % 11 <> 0", "") + "SELECT doc_id, day, pair_index, entry_ts, exit_ts FROM q",
    "header_fields": f"""SELECT c_custkey, CASE WHEN c_custkey * 3 >= 1000 THEN rtrim(translate(upper(c_name), '#0123456789', ' ABCDEFGHIJ')) END AS employee_name, CASE WHEN c_custkey * 3 >= 1000 THEN (c_custkey * 3)::VARCHAR END AS employee_id,
  CASE WHEN c_custkey % 13 = 12 THEN 'MAGGIOX' ELSE {_MONTHS}[c_custkey % 13 + 1] END AS month_name, CASE WHEN c_custkey % 13 < 12 THEN (c_custkey % 13 + 1)::INTEGER END AS month, (2000 + c_custkey % 30)::INTEGER AS year,
  NULL::VARCHAR AS unit, NULL::VARCHAR AS turno, NULL::VARCHAR AS qualifica FROM customer""",
    "odd_lines": """SELECT c_custkey, CASE WHEN c_custkey % 5 >= 3 THEN '1,2' ELSE '2' END AS days, '1/0,2/0' AS pairs, CASE c_custkey % 5 WHEN 4 THEN 4.0 ELSE 3.0 END::DOUBLE AS first_worked FROM customer""",
    "repeated_keys": """SELECT 'id:' || o_custkey AS key, min(o_orderkey) AS place, max(o_orderkey) AS from_seq, 'N ' || max(o_orderkey) AS employee, o_custkey::VARCHAR AS employee_id FROM orders GROUP BY o_custkey""",
    "pair_durations": _PAIRS + "SELECT doc_id, day, pair_index, printf('%02d:%02d', minutes // 60, minutes % 60) AS duration_hhmm, minutes FROM q",
    "shift_label": _PAIRS + """, s AS (SELECT *, hour(entry_ts) * 60 + minute(entry_ts) AS m FROM q)
SELECT doc_id, day, pair_index, CASE WHEN m IS NULL THEN NULL WHEN abs(m - 480) <= abs(m - 840) AND abs(m - 480) <= abs(m - 1200) THEN 'Mattina' WHEN abs(m - 840) <= abs(m - 1200) THEN 'Pomeriggio' ELSE 'Notte' END AS turno FROM s""",
    "unmatched_events": _PAIRS + "SELECT doc_id, day, pair_index, entry_ts, exit_ts FROM q WHERE entry_ts IS NULL OR exit_ts IS NULL",
    "overnight_rollover": """
WITH e AS (SELECT event_id, date_trunc('minute', ts) AS a, ts::DATE::TIMESTAMP + to_minutes((event_id * 7) % 1440) AS b FROM events),
r AS (SELECT event_id, a, CASE WHEN b < a THEN b + INTERVAL 1 DAY ELSE b END AS b FROM e)
SELECT event_id, b::TIMESTAMP AS exit_ts, printf('%02d:%02d', date_diff('minute', a, b) // 60, date_diff('minute', a, b) % 60) AS duration_hhmm FROM r""",
    "day_runs": """
WITH e AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS changed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, sum(changed) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run_id FROM e""",
    "day_lines": _DAYS + f"""SELECT user_id || '-' || strftime(d, '%Y%m') AS doc_id, year(d)::INTEGER AS year, month(d)::INTEGER AS month, day(d)::INTEGER AS day,
['LU', 'MA', 'ME', 'GI', 'VE', 'SA', 'DO'][isodow(d)] AS dow, {_hours('f')} AS mo_f, 6.0::DOUBLE AS mo_t, {_hours('worked')} AS mo_lav FROM dd WHERE user_id % 11 <> 0""",
    "numeric_tokens": f"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(text, '{_SPACE}'), lambda x: regexp_full_match(x, '[+-]?[0-9]+(\\.[0-9]+)?')) AS n FROM documents)
SELECT doc_id, len(n)::BIGINT AS n, array_to_string(n, ' ') AS tokens FROM t""",
    "line_scan": r"""
WITH l AS (SELECT doc_id, string_split_regex(text, '\r\n|[\n\x0B\x0C\r\x1C-\x1E\x{85}\x{2028}\x{2029}]') AS x FROM documents),
m AS (SELECT doc_id, CASE WHEN x[-1] = '' THEN x[:-2] ELSE x END AS x FROM l)
SELECT doc_id, (i - 1)::BIGINT AS line_no, md5(x[i]) AS line_md5 FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM m)""",
    "hhmm_decimal": f"""
WITH v AS (SELECT l_orderkey, l_linenumber, {_V} AS v FROM lineitem),
m AS (SELECT *, (sign(v) * (floor(abs(v)) * 60 + round_even((abs(v) - floor(abs(v))) * 100, 0)))::BIGINT AS minutes FROM v)
SELECT l_orderkey, l_linenumber, round(sign(v) * (floor(abs(v)) + round_even((abs(v) - floor(abs(v))) * 100, 0) / 60), 9) AS hours, minutes FROM m""",
    "totals_map": _DAYS + f"""SELECT doc_id, 'ore_lavorate' AS label, {_hours('total')} AS value FROM ok WHERE user_id % 7 <> 0
UNION ALL SELECT doc_id, 'ore_dovute_contrattuali', 40.0 FROM ok UNION ALL SELECT doc_id, 'dbcr_netto', {_hours('(total - 2400)')} FROM ok""",
    "totals_wide": _DAYS + f"""SELECT doc_id, CASE WHEN user_id % 7 <> 0 THEN {_hours('total')} END AS ore_lavorate, NULL::DOUBLE AS ore_dovute_programmate, 40.0::DOUBLE AS ore_dovute_contrattuali,
NULL::DOUBLE AS dbcr_lordo_confermato, {_hours('(total - 2400)')} AS dbcr_netto, NULL::DOUBLE AS saldo_al_mese_precedente, NULL::DOUBLE AS saldo_al_mese_corrente FROM ok""",
    "validation": _DAYS + """SELECT doc_id, round(worked / 60.0, 6) AS ore_lavorate_row_sum, CASE WHEN user_id % 7 <> 0 THEN round(total / 60.0, 6) END AS ore_lavorate_total,
CASE WHEN user_id % 7 <> 0 THEN round((worked - total) / 60.0, 6) END AS ore_lavorate_diff, user_id % 7 <> 0 AND worked = total AS is_ok FROM ok""",
    "status_summary": _DAYS + """SELECT CASE WHEN user_id % 11 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN user_id % 11 = 0 THEN 'no day lines found' END AS error, count(*) AS n FROM doc GROUP BY ALL""",
    "month_lookup": f"""SELECT {_MONTHS}[month(o_orderdate)] || CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE '' END AS month_name, CASE WHEN o_orderkey % 3 <> 0 THEN month(o_orderdate)::INTEGER END AS month,
year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY ALL""",
    "employee_header": f"""
WITH t AS (SELECT c_custkey, {_NAME_SQL} AS name, (c_custkey * 3)::VARCHAR AS id FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 AND len(id) >= 4 THEN trim(name) END AS employee_name, CASE WHEN c_custkey % 9 <> 0 AND len(id) >= 4 THEN id END AS employee_id FROM t""",
    "normalize_terms": f"""
WITH x AS (SELECT 'page' AS kind, page_id AS id, '  ' || replace(url, '/', ' ') AS x FROM pages UNION ALL SELECT 'part', p_partkey, p_type || '__' || p_name FROM part)
SELECT kind, id, {_squeezed("translate(lower(x), '_-', '  ')")} AS term, {_squeezed('lower(x)')} AS name FROM x""",
    "file_exclusion": """
WITH t AS (SELECT unnest(['ring', 'red', 'small ring', 'bolt']) AS term, unnest(range(4)) AS i),
m AS (SELECT p_partkey, arg_min(term, i) AS reason FROM part JOIN t ON contains(lower(p_name), term) GROUP BY p_partkey)
SELECT p_partkey, reason FROM part LEFT JOIN m USING (p_partkey)""",
    "tree_walk": _TREE + "SELECT employee_id, folder_id, level::INTEGER AS level FROM walk WHERE reason IS NULL",
    "folder_exclusion": _TREE + "SELECT employee_id, folder_id, folder_name, reason FROM walk WHERE reason IS NOT NULL",
    "scan_items": _TREE + "SELECT * FROM items",
    "scan_counts": _TREE + """SELECT f.name AS employee, f.id AS employee_id, count(*) FILTER (i.section = 'included') AS included, count(*) FILTER (i.section = 'skipped') AS skipped_files,
(SELECT count(*) FROM walk w WHERE w.employee_id = f.id AND w.reason IS NOT NULL) AS excluded_folders FROM f LEFT JOIN items i ON i.employee_id = f.id WHERE f.parent_id = 'root' GROUP BY f.name, f.id""",
    "file_type_filter": """
WITH k AS (SELECT page_id, CASE WHEN url LIKE '%.html' THEN 'pdf' WHEN page_id % 5 = 0 OR page_id % 7 = 0 OR lower(url) LIKE '%.zip' THEN 'zip' END AS kind FROM pages)
SELECT page_id, kind FROM k WHERE kind IS NOT NULL""",
    "safe_names": f"SELECT page_id, {_safe('repeat(url, 3)')} AS safe, {_safe('url')} || CASE WHEN lower({_safe('url')}) LIKE '%.pdf' THEN '' ELSE '.pdf' END AS file FROM pages",
    "file_tags": f"SELECT page_id, {_TAG_NAME} AS shown, regexp_replace({_safe(_TAG_NAME)}, '\\.[pP][dD][fF]$', '') || '__' || left({_TAG_ID}, 8) AS tag FROM pages",
    "employee_keys": f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey::VARCHAR END AS pid, CASE WHEN c_custkey % 5 <> 0 THEN ' ' || c_name || '  ' || c_mktsegment END AS name FROM customer)
SELECT c_custkey, CASE WHEN pid IS NOT NULL THEN 'id:' || pid WHEN name IS NULL THEN 'name:unknown' ELSE 'name:' || {_squeezed('lower(name)')} END AS key, coalesce(name, 'unknown') AS name FROM c""",
    "report_merge": _NEW + _ITEM_ROWS,
    "legacy_merge": _OLDER + _ITEM_ROWS,
    "finalize_counts": _NEW + _PEOPLE.format(more=_OPENED) + "SELECT key, employee, employee_id, coalesce(included, 0)::BIGINT AS included, coalesce(skipped, 0)::BIGINT AS skipped_files, 0::BIGINT AS excluded_folders FROM people LEFT JOIN n USING (key)",
    "cached_anti_join": """
WITH o AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 50 = 0 THEN '' WHEN o_orderkey % 51 <> 0 THEN (o_orderkey % 5000)::VARCHAR END AS file_id FROM orders),
done AS (SELECT file_id FROM o WHERE o_orderstatus <> 'O' AND file_id <> '' AND file_id::INTEGER % 3 = 0)
SELECT o_orderkey, file_id FROM o WHERE o_orderstatus = 'O' AND (file_id IS NULL OR file_id = '' OR NOT EXISTS (SELECT 1 FROM done WHERE done.file_id = o.file_id))""",
    "sorted_index": """
WITH p AS (SELECT page_id, CASE WHEN page_id % 8 <> 0 THEN url END AS path, split_part(url, '/', 3) AS host FROM pages WHERE page_id % 3 <> 0)
SELECT page_id::VARCHAR AS id, coalesce(path, page_id::VARCHAR) AS shown, row_number() OVER (PARTITION BY host ORDER BY lower(coalesce(path, '')), page_id) AS place FROM p""",
    "report_json": _NEW + _PEOPLE.format(more=_OPENED) + _JSON,
    "manifest_json": _OLDER + _PEOPLE.format(more=_NONE) + _JSON,
}
