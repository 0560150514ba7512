"""The registered queries in SQL."""

from __future__ import annotations

from workload.adapters import (LO, PM_MEMBER_SQL, PROJ_SQL, T0, T1, T2, T3, TEAM_MEMBER_SQL,
                               TEAM_OBJECT_SQL)

CHANGE = "coalesce(mod_date, create_date)"


def _ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def _text(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%gZ') AS {name or column}"


def _second(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.000Z') AS {column}"


_PROJ_FIELDS = f"pid, cust, prio, {_text('create_date')}, {_text('mod_date')}"
_PROJ_DOC = f"CAST(pid AS VARCHAR) AS doc_id, {_PROJ_FIELDS}"

_LINES = """lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS doc_id, l_partkey, l_suppkey, l_quantity, l_shipdate
  FROM lineitem)"""

_EAV_PAIRS = """pairs AS (
  SELECT user_id, lower(event_type) AS key, CAST(value AS VARCHAR) AS value, ts, event_id
  FROM events)"""

_LATEST = _EAV_PAIRS + """, latest AS (
  SELECT user_id, key, arg_max(value, (ts, event_id)) AS value FROM pairs GROUP BY user_id, key)"""


def _in_one(repeat: int) -> str:
    return f"""custom AS (
  SELECT user_id, string_agg(repeat(key || ' ' || coalesce(value, 'null') || ' ', {repeat}), ''
                             ORDER BY ts, event_id) AS custom_fields
  FROM pairs GROUP BY user_id)"""


def _custom_in_one(repeat: int) -> str:
    return f"""WITH {_EAV_PAIRS}, {_in_one(repeat)}
SELECT c_custkey, c_name, c_mktsegment, custom_fields
FROM customer LEFT JOIN custom ON user_id = c_custkey"""


_TEAMS = f"{PROJ_SQL}, {TEAM_OBJECT_SQL}, {TEAM_MEMBER_SQL}, {PM_MEMBER_SQL}"


def _documents(lists: str, where: str) -> str:
    return f"""SELECT pid, cust, prio, {_second('mod_date')}, {_second('create_date')},
  c_name AS description, c_mktsegment AS comments, user_ids
FROM proj JOIN customer ON c_custkey = cust JOIN {lists} l ON l.object_id = pid
WHERE {where}"""


_CHANGED_TEAMS = f"""SELECT team_id FROM team_member
  WHERE mod_date > {_ts(LO)} AND mod_date < {_ts(T1)}"""
_IN_WINDOW = f"{CHANGE} > {_ts(LO)} AND {CHANGE} < {_ts(T1)}"
_BY_MEMBER = f"""pid IN (SELECT object_id FROM team_object
  WHERE class_id = 1000000 AND team_id IN ({_CHANGED_TEAMS}))"""

_FANOUT = f"""fanout AS (
  SELECT object_id, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS user_ids
  FROM team_member m JOIN team_object o ON m.team_id = o.team_id
    JOIN ({_CHANGED_TEAMS}) c ON c.team_id = o.team_id
  WHERE class_id = 1000000 AND current_record = 1 GROUP BY object_id)"""


_GAPS = """gaps AS (
  SELECT CASE WHEN pid % 5 <> 0 THEN pid END AS pid, CASE WHEN pid % 3 <> 0 THEN cust END AS cust,
    prio, create_date, mod_date FROM proj)"""


def _gap_report(flow: str, lo: str | None, hi: str) -> str:
    """A window reads from one second before the last; rows of that second are conflicts."""
    start = f"{CHANGE} > {_ts(lo)} - INTERVAL 1 SECOND AND" if lo else ""
    again = f"{CHANGE} < {_ts(lo)}" if lo else "false"
    return f"""SELECT '{flow}' AS flow, strftime({_ts(hi)}, '%Y-%m-%dT%H:%M:%S.%gZ') AS hi,
  count(*) FILTER (pid IS NOT NULL AND NOT ({again})) AS created,
  count(*) FILTER (pid IS NOT NULL AND {again}) AS conflicts,
  count(*) FILTER (pid IS NULL) AS rejected
FROM gaps WHERE {start} {CHANGE} < {_ts(hi)}"""


_LINE_ATTRIBUTES = """attributes AS (
  SELECT l_orderkey, 'line_' || l_linenumber AS key,
    CASE l_linenumber % 3 WHEN 0 THEN l_returnflag WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
      ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS value
  FROM lineitem WHERE l_linenumber BETWEEN 1 AND 7)"""
_LINE_FIELDS = ", ".join(f"max(value) FILTER (WHERE key = 'line_{i}') AS line_{i}"
                         for i in range(1, 8))


def _report(index: str, lookback: str) -> str:
    """The expected report rows of one spec: init at T0, sync at T1, sync at T3."""
    def window(last, now):
        lo = f"({_ts(last)} - INTERVAL {lookback})"
        inside = f"{CHANGE} > {lo} AND {CHANGE} < {_ts(now)}"
        return f"""SELECT '{index}' AS index_name, 'sync' AS flow, 'done' AS status,
  {_text(lo, 'lo')}, {_text(_ts(now), 'hi')},
  CAST(count(*) FILTER (WHERE {inside} AND {CHANGE} >= {_ts(last)}) AS BIGINT) AS created,
  CAST(count(*) FILTER (WHERE {inside} AND {CHANGE} < {_ts(last)}) AS BIGINT) AS conflicts,
  CAST(0 AS BIGINT) AS rejected FROM proj"""
    return f"""SELECT '{index}' AS index_name, 'init' AS flow, 'done' AS status,
  CAST(NULL AS VARCHAR) AS lo, {_text(_ts(T0), 'hi')},
  CAST(count(*) FILTER (WHERE {CHANGE} < {_ts(T0)}) AS BIGINT) AS created,
  CAST(0 AS BIGINT) AS conflicts, CAST(0 AS BIGINT) AS rejected FROM proj
UNION ALL {window(T0, T1)}
UNION ALL {window(T1, T3)}"""


_INIT_AND_SYNC = f"WITH {PROJ_SQL} SELECT {_PROJ_DOC} FROM proj WHERE {CHANGE} < {_ts(T3)}"

#: Loads with values that do not fit: each load takes the first row of an id; rows that fit and are
#: new become documents.
def _unfit_loads() -> str:
    out = [f"""WITH {PROJ_SQL},
src AS (SELECT CASE WHEN pid % 11 <> 0 THEN pid % 9973 END AS key, CAST(pid * 3 AS VARCHAR) AS code,
  CASE WHEN pid % 5 = 0 THEN 'unknown' ELSE CAST(cust AS VARCHAR) END AS price,
  CASE pid % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'true' WHEN 2 THEN 'maybe' END AS urgent,
  CASE WHEN pid % 6 = 0 THEN '1999-02-30' WHEN pid % 6 = 1 THEN 'soon' ELSE '1999-03-01' END AS day,
  prio AS label, pid, create_date, mod_date FROM proj),
told AS (SELECT *, list_filter([
  CASE WHEN pid * 3 > 32767 THEN {{'field': 'code', 'value': code, 'reason': 'not short'}} END,
  CASE WHEN pid % 5 = 0 THEN {{'field': 'price', 'value': price, 'reason': 'not long'}} END,
  CASE WHEN pid % 4 = 2 THEN {{'field': 'urgent', 'value': urgent, 'reason': 'not boolean'}} END,
  CASE WHEN pid % 6 IN (0, 1) THEN {{'field': 'day', 'value': day, 'reason': 'not yyyy-MM-dd'}} END],
  lambda x: x IS NOT NULL) AS bad FROM src),
docs0 AS (SELECT * FROM told WHERE false)"""]
    bounds = [(None, T0), (T0, T1), (T1, T3)]
    for i, (lo, hi) in enumerate(bounds, 1):
        low = f"{CHANGE} > {_ts(lo)} - INTERVAL 1 SECOND AND " if lo else ""
        out.append(f"""
batch{i} AS (SELECT * FROM told WHERE {low}{CHANGE} < {_ts(hi)}),
new{i} AS (SELECT * FROM batch{i} WHERE key IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY pid) = 1),
absent{i} AS (SELECT * FROM new{i} WHERE key NOT IN (SELECT key FROM docs{i - 1})),
docs{i} AS (SELECT * FROM docs{i - 1} UNION ALL SELECT * FROM absent{i} WHERE len(bad) = 0),
count{i} AS (SELECT '{"sync" if lo else "init"}' AS flow, {_text(_ts(hi), 'hi')},
  (SELECT count(*) FROM absent{i} WHERE len(bad) = 0) AS created,
  count(key) - (SELECT count(*) FROM absent{i}) AS conflicts, count(*) - count(key) AS rejected,
  (SELECT count(*) FROM absent{i} WHERE len(bad) > 0) AS errors FROM batch{i})""")
    return ",".join(out) + """,
docs AS (SELECT * FROM docs3),
failed AS (SELECT * FROM absent1 UNION ALL SELECT * FROM absent2 UNION ALL SELECT * FROM absent3),
counts AS (SELECT * FROM count1 UNION ALL SELECT * FROM count2 UNION ALL SELECT * FROM count3)"""


_UNFIT = _unfit_loads()

#: Events as custom fields with types, the last of each user and key.
_TYPED = f"""WITH last AS (SELECT user_id, lower(event_type) AS k, value, props, ts FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, lower(event_type) ORDER BY ts DESC, event_id DESC) = 1),
typed AS (
  SELECT user_id, k AS key, 'DOUBLE' AS kind, CAST(to_json(value) AS VARCHAR) AS json FROM last
  UNION ALL SELECT user_id, 'props_' || k, 'OBJECT<k: BIGINT>', replace(props, ' ', '') FROM last
  UNION ALL SELECT user_id, 'at_' || k, 'STRING', '"' || {_text('ts').rpartition(' AS ')[0]} || '"' FROM last)"""

#: Deliveries of events: every tenth comes with the next one. Late is what lies two days before the
#: newest time of the deliveries before.
_LATE = """WITH cut AS (SELECT TIMESTAMP '2024-01-10' AS a, TIMESTAMP '2024-01-20' AS b),
fed AS (
  SELECT 0 AS batch, event_id, ts, event_type FROM events, cut WHERE event_id % 10 <> 0 AND ts < a
  UNION ALL SELECT 1, event_id, ts, event_type FROM events, cut
  WHERE (event_id % 10 <> 0 AND ts > a - INTERVAL 1 DAY AND ts < b) OR (event_id % 10 = 0 AND ts < a)
  UNION ALL SELECT 2, event_id, ts, event_type FROM events, cut
  WHERE (event_id % 10 <> 0 AND ts > b - INTERVAL 1 DAY)
    OR (event_id % 10 = 0 AND ts > a - INTERVAL 1 DAY AND ts < b)),
mark AS (SELECT b.batch, max(f.ts) - INTERVAL 2 DAY AS w FROM range(3) b(batch)
  LEFT JOIN fed f ON f.batch < b.batch GROUP BY b.batch),
told AS (SELECT fed.*, coalesce(ts < w, false) AS late,
  row_number() OVER (PARTITION BY event_id, coalesce(ts < w, false) ORDER BY fed.batch) AS n
  FROM fed JOIN mark USING (batch))"""

ORACLE = {
    "q01_full_scan_bound":
        f"WITH {PROJ_SQL} SELECT {_PROJ_FIELDS} FROM proj WHERE {CHANGE} < {_ts(T0)}",
    "q02_window_scan":
        f"WITH {PROJ_SQL} SELECT {_PROJ_FIELDS} FROM proj WHERE {_IN_WINDOW}",
    "q03_doc_id_composite":
        "SELECT conv_id || '-' || turn AS doc_id, conv_id, turn, role, text FROM conversations",
    "q04_create_if_absent": f"""WITH {_LINES}
SELECT doc_id, l_partkey, l_suppkey, l_quantity, {_text('l_shipdate')} FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id
    ORDER BY l_shipdate, l_partkey, l_suppkey) AS n FROM lines) WHERE n = 1""",
    "q05_outcomes": f"""WITH {_LINES}
SELECT 'created' AS outcome, CAST(count(DISTINCT doc_id) AS BIGINT) AS n FROM lines
UNION ALL
SELECT 'conflict', CAST(count(*) - count(DISTINCT doc_id) AS BIGINT) FROM lines""",
    "q05_refused_rows": f"""WITH {_LINES}
SELECT doc_id, l_partkey, l_suppkey, l_quantity, {_text('l_shipdate')},
  CAST(count(*) AS BIGINT) AS refused
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id
        ORDER BY l_shipdate, l_partkey, l_suppkey) AS n FROM lines) WHERE n > 1
GROUP BY doc_id, l_partkey, l_suppkey, l_quantity, l_shipdate""",
    "q06_ext_flatten": f"""WITH {_LATEST}
SELECT c_custkey, c_name, c_mktsegment, max(value) FILTER (WHERE key = 'click') AS click,
  max(value) FILTER (WHERE key = 'view') AS view,
  max(value) FILTER (WHERE key = 'purchase') AS purchase,
  max(value) FILTER (WHERE key = 'signup') AS signup,
  max(value) FILTER (WHERE key = 'error') AS error
FROM customer LEFT JOIN latest ON user_id = c_custkey GROUP BY c_custkey, c_name, c_mktsegment""",
    "q06_ext_flatten_open": f"""WITH {_LATEST}
SELECT c_custkey, key, value FROM customer JOIN latest ON user_id = c_custkey""",
    "q07_ext_custom_in_one": _custom_in_one(1),
    "q08_ext_custom_in_one_repeat": _custom_in_one(3),
    "q09_ext_typed_values": """
SELECT l_orderkey AS pid, 'Line_' || l_linenumber AS param_name,
  CASE l_linenumber % 3 WHEN 0 THEN l_returnflag WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS attribute_value
FROM lineitem WHERE l_linenumber BETWEEN 1 AND 7""",
    "q10_ext_batch_scan": f"""WITH {PROJ_SQL}
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id IN (SELECT cust FROM proj WHERE {_IN_WINDOW})""",
    "q11_member_list": f"WITH {TEAM_OBJECT_SQL}, {TEAM_MEMBER_SQL}, {PM_MEMBER_SQL} "
                       "SELECT object_id, user_ids FROM pm_member",
    "q12_full_document": f"WITH {_TEAMS} " + _documents("pm_member", f"{CHANGE} < {_ts(T2)}"),
    "q13_changed_union": f"WITH {_TEAMS} " + _documents(
        "pm_member", f"({_IN_WINDOW}) OR {_BY_MEMBER}"),
    "q43_captured_changes": f"WITH {_TEAMS} " + _documents(
        "pm_member", f"({_IN_WINDOW}) OR {_BY_MEMBER}"),
    "q14_changed_union_fanout": f"WITH {_TEAMS}, {_FANOUT} "
        + _documents("pm_member", _IN_WINDOW) + " UNION " + _documents("fanout", "true"),
    "q15_mapping": f"""WITH {_TEAMS}
SELECT CAST(pid AS VARCHAR) AS doc_id, CAST(pid AS VARCHAR) AS pid, {_text('create_date')},
  {_text('mod_date')}, unnest(string_split(user_ids, ',')) AS token
FROM proj JOIN pm_member ON object_id = pid""",
    "q16_bulk_payload": """
SELECT '{"create":{"_index":"conversations","_id":"' || conv_id || '-' || turn || '"}}' || chr(10)
  || CAST(to_json({'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text}) AS VARCHAR)
  AS value
FROM conversations""",
    "q16_bulk_export": """
SELECT unnest(['{"create":{"_index":"documents","_id":"' || doc_id || '"}}',
  CAST(to_json({'lang': lang, 'n_chars': n_chars, 'text': text}) AS VARCHAR)]) AS value
FROM documents""",
    "q17_recreate_target": "SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_name, c_nationkey, "
                           "c_mktsegment FROM customer",
    "q18_latest_state": f"""
SELECT 'index_' || user_id AS index_name, {_text('arg_max(ts, event_id)', 'last_refresh_time')}
FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) <> 'error'""",
    "q19_init_then_sync": _INIT_AND_SYNC,
    "q20_fix_by_key": f"WITH {PROJ_SQL} SELECT {_PROJ_DOC} FROM proj WHERE pid IN (1, 7, 42) "
                      f"AND {CHANGE} IS NOT NULL",
    "q20_fix_many_keys": f"""WITH {PROJ_SQL} SELECT {_PROJ_DOC} FROM proj
WHERE {CHANGE} < {_ts(T3)} AND pid IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
    "q21_run_report": f"""WITH {PROJ_SQL}
SELECT 'proj' AS index_name, 'sync' AS flow, 'skipped' AS status, CAST(NULL AS VARCHAR) AS lo,
  CAST(NULL AS VARCHAR) AS hi, CAST(0 AS BIGINT) AS created, CAST(0 AS BIGINT) AS conflicts,
  CAST(0 AS BIGINT) AS rejected
UNION ALL {_report('proj', '1 SECOND')}
UNION ALL {_report('wide', '30 DAY')}""",
    "q22_stream_ticks": _INIT_AND_SYNC,
    "q23_stream_feed": f"SELECT CAST(event_id AS VARCHAR) AS doc_id, {_text('ts')}, user_id, "
                       "event_type FROM events",
    "q24_reconcile": """
SELECT 'missing' AS side, CAST(doc_id AS VARCHAR) AS doc_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT 'orphan', CAST(doc_id AS VARCHAR) FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
    "q24_counts": """
SELECT CAST(s AS BIGINT) AS source_rows, CAST(t AS BIGINT) AS target_rows, s = t AS matches
FROM (SELECT (SELECT count(*) FROM documents) AS s, (SELECT count(*) FROM labels) AS t)""",
    "q24_table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS total FROM {t}"
        for t in ("customer", "orders", "lineitem", "events")),
    "q24_repair": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, n_chars, text "
                  "FROM documents",
    "q25_delete": "SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_custkey, o_orderstatus "
                  "FROM orders WHERE o_orderstatus <> 'F'",
    "q26_all_in_one": f"""WITH {_EAV_PAIRS}, {_in_one(1)}
SELECT c_custkey, 'c_custkey ' || c_custkey || ' c_name ' || coalesce(c_name, 'null')
  || ' c_nationkey ' || coalesce(CAST(c_nationkey AS VARCHAR), 'null')
  || ' c_acctbal ' || coalesce(CAST(c_acctbal AS VARCHAR), 'null')
  || ' c_mktsegment ' || coalesce(c_mktsegment, 'null') || ' '
  || coalesce(custom_fields, '') AS all_fields
FROM customer LEFT JOIN custom ON user_id = c_custkey""",
    "q27_upsert": f"""WITH {_LINES}
SELECT doc_id, l_partkey, l_suppkey, l_quantity, {_text('l_shipdate')} FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS n FROM lines) WHERE n = 1""",
    "q28_pushed_window": f"""
SELECT l_orderkey, l_linenumber, l_partkey, {_text('l_shipdate')} FROM lineitem
WHERE l_shipdate > {_ts(LO)} AND l_shipdate < {_ts(T1)}""",
    "q29_protected_ids": """
SELECT 'c_custkey' AS key, CAST(count(DISTINCT c_custkey) AS BIGINT) AS n
FROM customer JOIN events ON user_id = c_custkey WHERE event_type = 'error'
HAVING count(*) > 0""",
    "q30_follow_members": f"WITH {_TEAMS} SELECT CAST(pid AS VARCHAR) AS doc_id, d.* FROM ("
        + _documents("pm_member", f"{CHANGE} < {_ts(T0)} OR ({_IN_WINDOW}) OR {_BY_MEMBER}")
        + ") d",
    "q31_full_load_enriched": f"""WITH {PROJ_SQL}, {_LINE_ATTRIBUTES}
SELECT {_PROJ_DOC}, custom_fields FROM proj LEFT JOIN (
  SELECT l_orderkey, string_agg(key || ' ' || coalesce(value, 'null') || ' ', ''
                                ORDER BY key, value) AS custom_fields
  FROM attributes GROUP BY l_orderkey) a ON l_orderkey = pid
WHERE {CHANGE} IS NOT NULL""",
    "q32_windows_enriched": f"""WITH {PROJ_SQL}, {_LINE_ATTRIBUTES}
SELECT {_PROJ_DOC}, line_1, line_2, line_3, line_4, line_5, line_6, line_7 FROM proj LEFT JOIN (
  SELECT l_orderkey, {_LINE_FIELDS} FROM attributes GROUP BY l_orderkey) a ON l_orderkey = pid
WHERE {CHANGE} < {_ts(T3)}""",
    "q33_rows_without_ids": f"""WITH {PROJ_SQL}, {_GAPS}
{_gap_report('init', None, T0)} UNION ALL {_gap_report('sync', T0, T1)}
UNION ALL {_gap_report('sync', T1, T3)}""",
    "q34_null_extension_ids": f"""WITH {PROJ_SQL}, {_GAPS}, {_LATEST}
SELECT CAST(pid AS VARCHAR) AS doc_id, pid, cust, prio, {_text('create_date')},
  {_text('mod_date')}, max(value) FILTER (WHERE key = 'click') AS click,
  max(value) FILTER (WHERE key = 'view') AS view,
  max(value) FILTER (WHERE key = 'purchase') AS purchase,
  max(value) FILTER (WHERE key = 'signup') AS signup,
  max(value) FILTER (WHERE key = 'error') AS error
FROM gaps LEFT JOIN latest ON user_id = cust
WHERE pid IS NOT NULL AND {CHANGE} < {_ts(T3)} GROUP BY pid, cust, prio, create_date, mod_date""",
    "q35_mapped_types": """
SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CAST(o_orderkey AS INTEGER) AS code, o_totalprice, starts_with(o_orderpriority, '1') AS urgent,
  epoch_ms(o_orderdate) AS o_orderdate, strftime(o_orderdate, '%Y-%m-%d') AS day,
  o_orderpriority AS whole,
  list_filter(string_split(o_orderpriority, '-'), lambda x: x <> '')[-1] AS last_token,
  CAST(len(list_filter(string_split(o_orderpriority, ' '), lambda x: x <> '')) AS INTEGER) AS n_words
FROM orders""",
    "q36_single_documents": """
WITH k AS (SELECT o_orderkey % 3 <> 0 AS there, o_custkey % 10 <> 0 AS has_id FROM orders
  WHERE o_orderstatus = 'F'),
n AS (SELECT count(*) FILTER (has_id AND NOT there) AS created,
  count(*) FILTER (has_id AND there) AS conflicts, count(*) FILTER (NOT has_id) AS rejected FROM k)
SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0) + created AS documents,
  created AS notes, created, conflicts, rejected FROM n""",
    "q38_pushed_sql_window":
        f"WITH {PROJ_SQL} SELECT {_PROJ_FIELDS} FROM proj WHERE {_IN_WINDOW}",
    "q39_range_differences": """
WITH d AS (SELECT doc_id, doc_id % 23 = 0 AS moved, doc_id % 13 <> 0 AS kept,
  (doc_id % 17 = 0 AND lang IS NOT NULL) OR (doc_id % 19 = 0 AND n_chars IS NOT NULL) AS other
  FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN moved OR NOT kept THEN 'missing' ELSE 'changed' END AS kind
FROM d WHERE moved OR NOT kept OR other
UNION ALL SELECT CAST(-doc_id - 1 AS VARCHAR), 'orphan' FROM d WHERE moved AND kept""",
    "q39_repair_differences": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, n_chars, text "
                              "FROM documents",
    "q40_late_rows": f"""{_LATE}
SELECT CAST(event_id AS VARCHAR) AS doc_id, {_text('ts')}, event_type, batch AS late_in_batch
FROM told WHERE late""",
    "q40_late_counts": f"""{_LATE}
SELECT batch, count(*) FILTER (NOT late AND n = 1) AS kept, count(*) FILTER (NOT late AND n > 1) AS repeats,
  count(*) FILTER (late) AS late FROM told GROUP BY batch""",
    "q40_late_readmitted": f"""{_LATE}
SELECT DISTINCT CAST(event_id AS VARCHAR) AS doc_id, {_text('ts')}, event_type FROM told""",
    "q41_run_history": """
SELECT 'docsync-proj' AS query, CAST(1 AS BIGINT) AS batches, CAST(1 AS BIGINT) AS input_rows,
  CAST(0 AS BIGINT) AS dropped_rows, CAST(b AS BIGINT) AS last_batch, 'ended' AS state,
  CAST(NULL AS VARCHAR) AS error FROM range(2) t(b)""",
    "q42_typed_custom_fields": f"""{_TYPED}
SELECT c_custkey, key, kind, json FROM customer JOIN typed ON user_id = c_custkey""",
    "q42_typed_documents": f"""{_TYPED}
SELECT '{{"create":{{"_index":"customers","_id":"' || c_custkey || '"}}}}' || chr(10) || '{{"c_custkey":'
  || c_custkey || ',"c_name":' || to_json(any_value(c_name)) || ',"c_mktsegment":'
  || to_json(any_value(c_mktsegment)) || coalesce(string_agg(',"' || key || '":' || json, '' ORDER BY key), '')
  || '}}' AS value
FROM customer LEFT JOIN typed ON user_id = c_custkey GROUP BY c_custkey""",
    "q37_unfit_counts": f"{_UNFIT} SELECT * FROM counts",
    "q37_unfit_rows": f"""{_UNFIT}
SELECT DISTINCT CAST(key AS VARCHAR) AS doc_id, e.field, e.value, e.reason
FROM (SELECT key, unnest(bad) AS e FROM failed)""",
    "q37_fit_documents": f"""{_UNFIT}
SELECT CAST(key AS VARCHAR) AS doc_id, key, CAST(code AS SMALLINT) AS code,
  CAST(price AS BIGINT) AS price, CASE WHEN urgent IS NOT NULL THEN true END AS urgent, day, label,
  pid, {_text('create_date')}, {_text('mod_date')} FROM docs""",
}
