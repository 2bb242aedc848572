"""Independent SQL statements (DuckDB dialect) for the query catalogue.

They state each result directly over the driver tables; the message
corpus and the lookup are written out here as plain SQL so that they do
not depend on the Spark code under test.
"""

from __future__ import annotations

# Must equal the parameters in ``queries.py``.
ORDERS_MARK = "1998-01-01T00:00:00.000000"
FUTURE_MARK = "2100-01-01T00:00:00.000000"
ISO = "%Y-%m-%dT%H:%M:%S.%f"

MSG = """
base AS (
  SELECT event_id, user_id,
         'e' || CAST(event_id // 3 AS VARCHAR) AS k,
         'u' || CAST(user_id AS VARCHAR) AS u,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t,
         strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f+02:00') AS t2,
         props AS p
  FROM events),
msg AS (
  SELECT event_id AS seq, CASE event_id % 20
    WHEN 0 THEN '{bad'
    WHEN 1 THEN '[1,2]'
    WHEN 2 THEN '{"event_id":"' || k || '","timestamp":"' || t || '","payload":' || p || '}'
    WHEN 3 THEN '{"event_id":' || CAST(event_id // 3 AS VARCHAR) || ',"user_id":"' || u || '","timestamp":"' || t || '","payload":' || p || '}'
    WHEN 4 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"' || t || '","payload":null}'
    WHEN 5 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"' || t || '","payload":[1]}'
    WHEN 6 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"not a time","payload":' || p || '}'
    WHEN 7 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"' || t || '"}'
    WHEN 8 THEN '{"event_id":"' || k || '","user_id":"","timestamp":"' || t || '","payload":' || p || '}'
    WHEN 9 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"' || t || '","payload":' || p || ',"x":1}'
    WHEN 10 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"' || t || '","payload":' || p || ',"user_name":"preset"}'
    WHEN 11 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"12:30:00","payload":' || p || '}'
    WHEN 12 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"2024","payload":' || p || '}'
    WHEN 13 THEN '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"' || t2 || '","payload":' || p || '}'
    ELSE '{"event_id":"' || k || '","user_id":"' || u || '","timestamp":"' || t || '","payload":' || p || '}'
  END AS text FROM base),
dec AS (SELECT seq, CAST(text AS JSON) AS j FROM msg WHERE json_valid(text)),
val AS (
  SELECT seq, j,
    CASE WHEN json_type(j) <> 'OBJECT' THEN 'not_object'
         WHEN coalesce(json_type(j, '$.event_id') <> 'VARCHAR', true) THEN 'bad_event_id'
         WHEN coalesce(json_type(j, '$.user_id') <> 'VARCHAR', true) THEN 'bad_user_id'
         WHEN coalesce(json_type(j, '$.timestamp') <> 'VARCHAR', true) THEN 'bad_timestamp_type'
         WHEN json_type(j, '$.payload') IS NOT NULL AND json_type(j, '$.payload') <> 'OBJECT' THEN 'bad_payload'
    END AS reason,
    j ->> '$.event_id' AS event_id, j ->> '$.user_id' AS user_id, j ->> '$.timestamp' AS ts_text,
    CASE WHEN json_type(j, '$.payload') = 'OBJECT' THEN CAST(json_extract(j, '$.payload') AS VARCHAR) END AS payload,
    j ->> '$.user_name' AS user_name, j ->> '$.user_location' AS user_location
  FROM dec),
uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY seq % 4, seq) AS rn
    FROM val WHERE reason IS NULL AND event_id IS NOT NULL) WHERE rn = 1),
dim AS (
  SELECT 'u' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name, n_name AS user_location
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 <> 0),
enr AS (
  SELECT u.seq, u.event_id, u.user_id, u.ts_text, u.payload,
    CASE WHEN d.user_id IS NOT NULL THEN d.user_name ELSE u.user_name END AS user_name,
    CASE WHEN d.user_id IS NOT NULL THEN d.user_location ELSE u.user_location END AS user_location,
    d.user_id IS NOT NULL AS matched
  FROM uniq u LEFT JOIN dim d ON u.user_id = d.user_id AND u.user_id <> ''),
parsed AS (
  SELECT *, coalesce(try_strptime(ts_text, '%Y-%m-%dT%H:%M:%S.%fZ'),
                     try_strptime(replace(ts_text, '+02:00', ''), '%Y-%m-%dT%H:%M:%S.%f') - INTERVAL 2 HOUR) AS "timestamp"
  FROM enr),
sink AS (
  SELECT event_id, user_id, "timestamp", payload, user_name, user_location FROM parsed WHERE "timestamp" IS NOT NULL)
"""

SINK_SELECT = """SELECT event_id, user_id, "timestamp", payload, user_name, user_location,
       CAST("timestamp" AS DATE) AS event_date FROM sink"""

_MARKS = f"""
SELECT 'orders' AS table_name, TIMESTAMP '1998-01-01 00:00:00' AS old_mark, max(o_orderdate) AS batch_max,
       greatest(TIMESTAMP '1998-01-01 00:00:00', max(o_orderdate)) AS new_mark FROM orders
UNION ALL
SELECT 'lineitem', CAST(NULL AS TIMESTAMP), max(l_shipdate), max(l_shipdate) FROM lineitem
UNION ALL
SELECT 'events', TIMESTAMP '2100-01-01 00:00:00', max(ts), greatest(TIMESTAMP '2100-01-01 00:00:00', max(ts)) FROM events
"""

_GATE = f"""
WITH m AS (
  SELECT 'orders' AS table_name, 'o_orderdate' AS incremental_column, '{ORDERS_MARK}' AS old_mark,
         strftime(max(o_orderdate), '{ISO}') AS new_mark, count(*) AS rows,
         count(*) FILTER (WHERE o_orderkey IS NULL) AS failed
  FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL
  SELECT 'lineitem', 'l_shipdate', NULL, strftime(max(l_shipdate), '{ISO}'), count(*),
         count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
  UNION ALL
  SELECT 'events', 'ts', '{FUTURE_MARK}',
         coalesce(strftime(max(ts), '{ISO}'), '{FUTURE_MARK}'), count(*),
         count(*) FILTER (WHERE event_id IS NULL) FROM events WHERE ts > TIMESTAMP '2100-01-01 00:00:00'
  UNION ALL
  SELECT 'customer', NULL, NULL, NULL, count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM customer),
g AS (
  SELECT *, incremental_column IS NOT NULL AND failed = 0 AND rows > 0 AND new_mark IS NOT NULL
            AND new_mark IS DISTINCT FROM old_mark AS advanced FROM m)
SELECT table_name, incremental_column, old_mark, new_mark, rows, failed,
       CASE WHEN advanced THEN new_mark ELSE old_mark END AS mark, advanced FROM g
"""

_HWM_ADVANCE = f"""
SELECT 'orders' AS table_name, strftime(max(o_orderdate), '{ISO}') AS hwm_value, 'timestamp_ntz' AS hwm_type
FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
UNION ALL SELECT 'lineitem', strftime(max(l_shipdate), '{ISO}'), 'timestamp_ntz' FROM lineitem
UNION ALL SELECT 'events', '{FUTURE_MARK}', 'timestamp_ntz'
"""

_UPSERT_SRC = """
tgt AS (SELECT *, 'kept' AS t_note FROM customer WHERE c_custkey % 2 = 0),
src AS (
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS c_name, c_nationkey,
         CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer)
"""

_AFFECTED = """
WITH tgt AS (SELECT * FROM customer WHERE c_custkey % 2 = 0),
v1 AS (SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
              c_mktsegment, 1 AS ver FROM customer),
v2 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'CHANGED' AS c_mktsegment, 2 AS ver
       FROM v1 WHERE c_custkey % 4 = 0),
src AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2),
w AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.c_custkey ORDER BY s.ver) AS rn,
    lag(c_name) OVER (PARTITION BY s.c_custkey ORDER BY s.ver) AS p_name,
    lag(c_nationkey) OVER (PARTITION BY s.c_custkey ORDER BY s.ver) AS p_nation,
    lag(c_acctbal) OVER (PARTITION BY s.c_custkey ORDER BY s.ver) AS p_bal,
    lag(c_mktsegment) OVER (PARTITION BY s.c_custkey ORDER BY s.ver) AS p_seg
  FROM src s),
c AS (
  SELECT CASE
    WHEN w.rn = 1 AND t.c_custkey IS NULL THEN 'insert'
    WHEN w.rn = 1 AND (w.c_name IS DISTINCT FROM t.c_name OR w.c_nationkey IS DISTINCT FROM t.c_nationkey
         OR w.c_acctbal IS DISTINCT FROM t.c_acctbal OR w.c_mktsegment IS DISTINCT FROM t.c_mktsegment) THEN 'update'
    WHEN w.rn = 1 THEN 'same'
    WHEN w.c_name IS DISTINCT FROM w.p_name OR w.c_nationkey IS DISTINCT FROM w.p_nation
         OR w.c_acctbal IS DISTINCT FROM w.p_bal OR w.c_mktsegment IS DISTINCT FROM w.p_seg THEN 'update'
    ELSE 'same' END AS change
  FROM w LEFT JOIN tgt t ON w.c_custkey = t.c_custkey)
SELECT change, count(*) AS rows,
       CAST(sum(CASE change WHEN 'insert' THEN 1 WHEN 'update' THEN 2 ELSE 0 END) AS BIGINT) AS affected
FROM c GROUP BY change
"""

_LATEST_EVENTS = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
"""

_MIGRATE_RUN1 = f"""
SELECT 1 AS run, 'nation' AS table_name, 'ok' AS status, count(*) AS rows, count(*) AS affected,
       CAST(0 AS BIGINT) AS failed, CAST(NULL AS VARCHAR) AS old_mark, CAST(NULL AS VARCHAR) AS mark,
       false AS advanced FROM nation
UNION ALL SELECT 1, 'region', 'ok', count(*), count(*), 0, NULL, NULL, false FROM region
UNION ALL SELECT 1, 'orders', 'ok', count(*), count(*), 0, NULL, strftime(max(o_orderdate), '{ISO}'), true FROM orders
UNION ALL SELECT 1, 'broken', 'failed', 0, 0, 0, NULL, NULL, false
UNION ALL SELECT 1, 'unrouted', 'skipped', 0, 0, 0, NULL, NULL, false
"""

_MIGRATE_ALL = _MIGRATE_RUN1 + f"""
UNION ALL SELECT 2, 'nation', 'ok', count(*), 0, 0, NULL, NULL, false FROM nation
UNION ALL SELECT 2, 'region', 'ok', count(*), 0, 0, NULL, NULL, false FROM region
UNION ALL SELECT 2, 'orders', 'empty', 0, 0, 0, strftime(max(o_orderdate), '{ISO}'),
                 strftime(max(o_orderdate), '{ISO}'), false FROM orders
UNION ALL SELECT 2, 'broken', 'failed', 0, 0, 0, NULL, NULL, false
UNION ALL SELECT 2, 'unrouted', 'skipped', 0, 0, 0, NULL, NULL, false
"""

_RUN_SUMMARY = """
WITH per AS (
  SELECT 'nation' AS table_name, 'ok' AS status, count(*) AS rows_processed, count(*) AS rows_affected,
         CAST(0 AS BIGINT) AS rows_failed FROM nation
  UNION ALL SELECT 'region', 'ok', count(*), count(*), 0 FROM region
  UNION ALL SELECT 'orders', 'ok', count(*), count(*), 0 FROM orders
  UNION ALL SELECT 'broken', 'failed', 0, 0, 0
  UNION ALL SELECT 'unrouted', 'skipped', 0, 0, 0
  UNION ALL SELECT 'orders_late', 'empty', 0, 0, 0)
SELECT * FROM per
UNION ALL SELECT 'TOTAL', NULL, CAST(sum(rows_processed) AS BIGINT), CAST(sum(rows_affected) AS BIGINT),
                 CAST(sum(rows_failed) AS BIGINT) FROM per
"""

_CSV_RAW = """
WITH """ + "{SPLIT}" + """
SELECT 'nation.csv' AS file_name, 'n_nationkey' AS _c0, 'n_name' AS _c1, 'n_regionkey' AS _c2
UNION ALL SELECT 'nation.csv', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR) FROM nation
UNION ALL SELECT 'region.csv', 'r_regionkey', 'r_name', NULL
UNION ALL SELECT 'region.csv', CAST(r_regionkey AS VARCHAR), r_name, NULL FROM region
UNION ALL SELECT file_name, 's_suppkey', 's_name', 's_nationkey' FROM supplier_files
UNION ALL SELECT file_name, CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier_split
"""

_CSV_TYPED = """
WITH """ + "{SPLIT}" + """
SELECT 'nation.csv' AS file_name, n_nationkey, n_name, n_regionkey,
       CAST(NULL AS INTEGER) AS r_regionkey, CAST(NULL AS VARCHAR) AS r_name,
       CAST(NULL AS INTEGER) AS s_suppkey, CAST(NULL AS VARCHAR) AS s_name,
       CAST(NULL AS INTEGER) AS s_nationkey FROM nation
UNION ALL SELECT 'region.csv', NULL, NULL, NULL, r_regionkey, r_name, NULL, NULL, NULL FROM region
UNION ALL SELECT file_name, NULL, NULL, NULL, NULL, NULL, CAST(s_suppkey AS INTEGER), s_name,
                 CAST(s_nationkey AS INTEGER) FROM supplier_split
"""

_TEXT_WHOLE = """
SELECT 'regions.txt' AS file_name, true AS found, string_agg(r_name || chr(10), '' ORDER BY r_regionkey) AS content
FROM region
UNION ALL
SELECT 'suppliers.txt', true, string_agg(s_name || chr(10), '' ORDER BY s_suppkey) FROM supplier
UNION ALL SELECT 'missing.txt', false, NULL
"""

_COMBINE_ORDER = """
WITH """ + "{SPLIT}" + """,
files AS (SELECT * FROM (VALUES ('nation.csv'), ('region.csv')) f(file_name)
          UNION ALL SELECT file_name FROM supplier_files),
csv AS (
  SELECT 'nation.csv' AS file_name, CAST(0 AS BIGINT) AS line_no, 'n_nationkey,n_name,n_regionkey' AS line
  UNION ALL SELECT 'nation.csv', row_number() OVER (ORDER BY n_nationkey),
         CAST(n_nationkey AS VARCHAR) || ',' || n_name || ',' || CAST(n_regionkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'region.csv', 0, 'r_regionkey,r_name'
  UNION ALL SELECT 'region.csv', row_number() OVER (ORDER BY r_regionkey),
         CAST(r_regionkey AS VARCHAR) || ',' || r_name FROM region
  UNION ALL SELECT file_name, 0, 's_suppkey,s_name,s_nationkey' FROM supplier_files
  UNION ALL SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY s_suppkey),
         CAST(s_suppkey AS VARCHAR) || ',' || s_name || ',' || CAST(s_nationkey AS VARCHAR) FROM supplier_split),
txt AS (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS line_no, s_name AS line FROM supplier)
SELECT 'combined_' || file_name AS out_name, 0 AS section, line_no, line FROM csv
UNION ALL
SELECT 'combined_' || f.file_name, 1, t.line_no, t.line FROM files f, txt t
"""

# supplier is exported as supplier_<r>.csv, r = s_suppkey mod n, n = ceil(rows / 50000)
_SPLIT = """
split_n AS (SELECT greatest(1, CAST(ceil(count(*) / 50000.0) AS BIGINT)) AS n FROM supplier),
supplier_split AS (
  SELECT 'supplier_' || CAST(s_suppkey % n AS VARCHAR) || '.csv' AS file_name, s_suppkey, s_name, s_nationkey
  FROM supplier, split_n),
supplier_files AS (SELECT DISTINCT file_name FROM supplier_split)"""
_CSV_RAW = _CSV_RAW.replace("{SPLIT}", _SPLIT)
_CSV_TYPED = _CSV_TYPED.replace("{SPLIT}", _SPLIT)
_COMBINE_ORDER = _COMBINE_ORDER.replace("{SPLIT}", _SPLIT)

ORACLE_SQL: dict[str, str] = {
    "full_extract": "SELECT * FROM nation",
    "incremental_extract": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'",
    "initial_extract": "SELECT * FROM orders",
    "chunk_stats": """SELECT CAST(floor(o_orderkey / 10000) AS BIGINT) AS chunk_id, count(*) AS rows,
                      min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders GROUP BY 1""",
    "table_rename": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey,
                       c_acctbal AS balance, c_mktsegment FROM customer""",
    "select_mapped": "SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance FROM customer",
    "hwm_max": _MARKS,
    "hwm_numeric_coerce": """
        WITH t AS (SELECT o_orderstatus,
                     CASE WHEN o_orderkey % 2 = 0 THEN substr(o_orderpriority, 1, 1) ELSE o_orderpriority END AS x
                   FROM orders)
        SELECT o_orderstatus, max(try_cast(x AS DOUBLE)) AS hwm,
               count(try_cast(x AS DOUBLE)) AS numeric_rows,
               count(*) FILTER (WHERE try_cast(x AS DOUBLE) IS NULL) AS ignored_rows
        FROM t GROUP BY o_orderstatus""",
    "hwm_advance": _HWM_ADVANCE,
    "state_commit_gate": _GATE,
    "nan_to_null": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                      CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS l_discount,
                      CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax,
                      l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
    "type_coerce": """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE ts END AS ts_parsed,
                      CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value_num FROM events""",
    "fill_missing": """SELECT c_custkey, c_name, c_nationkey,
                       CASE WHEN c_custkey % 7 = 0 THEN 0.0 ELSE coalesce(c_acctbal, 0.0) END AS c_acctbal,
                       CASE WHEN c_custkey % 5 = 0 THEN 'UNKNOWN' ELSE coalesce(c_mktsegment, 'UNKNOWN') END AS c_mktsegment
                       FROM customer""",
    "upsert_merge": "WITH " + _UPSERT_SRC + """
        SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
               CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
               t.t_note
        FROM tgt t FULL JOIN src s ON t.c_custkey = s.c_custkey""",
    "upsert_last_wins": _LATEST_EVENTS,
    "affected_rows": _AFFECTED,
    "insert_only_conflicts": """
        WITH s AS (SELECT p_partkey FROM part), t AS (SELECT p_partkey FROM part WHERE p_partkey % 2 = 0),
        c AS (SELECT (SELECT count(*) FROM s) AS source_rows,
                     (SELECT count(*) FROM s WHERE p_partkey NOT IN (SELECT p_partkey FROM t)) AS new_keys,
                     (SELECT count(DISTINCT p_partkey) FROM s WHERE p_partkey IN (SELECT p_partkey FROM t)
                        OR p_partkey IN (SELECT p_partkey FROM s GROUP BY 1 HAVING count(*) > 1)) AS conflict_keys)
        SELECT source_rows, new_keys, conflict_keys,
               CASE WHEN conflict_keys > 0 THEN source_rows ELSE 0 END AS failed_rows,
               CASE WHEN conflict_keys > 0 THEN 0 ELSE new_keys END AS inserted_rows FROM c""",
    "incremental_two_runs": _LATEST_EVENTS,
    "incremental_two_runs_bucketed": _LATEST_EVENTS,
    "migrate_all": _MIGRATE_ALL,
    "run_summary": _RUN_SUMMARY,
    "json_decode_skip": "WITH " + MSG + "SELECT seq, lower(json_type(j)) AS kind FROM dec",
    "decode_stats": "WITH " + MSG + """SELECT count(*) AS messages,
                                       count(*) FILTER (WHERE json_valid(text)) AS decoded,
                                       count(*) FILTER (WHERE text IS NULL OR NOT json_valid(text)) AS skipped
                                       FROM msg""",
    "schema_validate": "WITH " + MSG + "SELECT seq, reason, event_id, user_id FROM val",
    "validation_stats": "WITH " + MSG + "SELECT coalesce(reason, 'valid') AS reason, count(*) AS messages FROM val GROUP BY 1",
    "dedup_first": "WITH " + MSG + "SELECT seq, event_id, user_id, ts_text, payload, user_name FROM uniq",
    "dedup_stats": "WITH " + MSG + """SELECT count(*) AS input_rows, count(DISTINCT event_id) AS unique_rows,
                                      count(*) - count(DISTINCT event_id) AS duplicates FROM val WHERE reason IS NULL""",
    "enrich_left": "WITH " + MSG + "SELECT seq, event_id, user_id, user_name, user_location, matched FROM enr",
    "enrich_stats": "WITH " + MSG + """SELECT count(*) AS processed, count(*) FILTER (WHERE matched) AS enriched,
                                       count(*) FILTER (WHERE NOT matched) AS missed FROM enr""",
    "enrich_lookup_down": "WITH " + MSG + """SELECT seq, event_id, user_id, user_name, user_location,
                                             false AS matched, false AS lookup_available FROM uniq""",
    "bounded_batch": "WITH " + MSG + "SELECT seq, lower(json_type(j)) AS kind FROM dec ORDER BY seq % 4, seq LIMIT 1000",
    "bounded_read": "WITH " + MSG + "SELECT seq, lower(json_type(j)) AS kind FROM dec ORDER BY seq % 4, seq LIMIT 1000",
    "range_balance": "SELECT count(*) AS rows, true AS many_ranges, true AS none_twice_too_large FROM orders",
    "daily_partition_append": "WITH " + MSG + """SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS rows
                                                 FROM sink GROUP BY 1""",
    "event_ingest_e2e": "WITH " + MSG + SINK_SELECT,
    "event_ingest_stream": "WITH " + MSG + SINK_SELECT,
    "event_ingest_stream_bounded": "WITH " + MSG + SINK_SELECT,
    "event_ingest_stream_dedup": "WITH " + MSG + SINK_SELECT,
    "ingest_summary": "WITH " + MSG + """
        SELECT count(*) AS messages, count(*) FILTER (WHERE NOT json_valid(text)) AS skipped,
               (SELECT count(*) FROM val WHERE reason IS NOT NULL) AS invalid,
               (SELECT count(*) FROM val WHERE reason IS NULL) - (SELECT count(*) FROM uniq) AS duplicates,
               (SELECT count(*) FROM enr WHERE matched) AS enriched, (SELECT count(*) FROM enr WHERE NOT matched) AS missed,
               (SELECT count(*) FROM parsed WHERE "timestamp" IS NULL) AS quarantined,
               (SELECT count(*) FROM sink) AS loaded, true AS lookup_available FROM msg""",
    "event_ingest_stream_invalid_first": "WITH " + MSG + SINK_SELECT,
    "ingest_no_rows": "WITH " + MSG + """
        SELECT 'none' AS batch, CAST(0 AS BIGINT) AS messages, CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS invalid,
               CAST(0 AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS enriched, CAST(0 AS BIGINT) AS missed,
               CAST(0 AS BIGINT) AS quarantined, CAST(0 AS BIGINT) AS loaded, true AS lookup_available
        UNION ALL
        SELECT 'invalid', count(*), count(*) FILTER (WHERE NOT json_valid(text)), count(*) FILTER (WHERE json_valid(text)),
               0, 0, 0, 0, 0, true FROM msg WHERE seq % 20 <= 5
        UNION ALL
        SELECT 'bad_timestamp', count(*), 0, 0, 0, count(d.user_id), count(*) - count(d.user_id), count(*), 0, true
        FROM val v LEFT JOIN dim d ON v.user_id = d.user_id WHERE seq % 20 = 6""",
    "ingest_rejects": "WITH " + MSG + """SELECT seq, reason FROM val WHERE reason IS NOT NULL
                                         UNION ALL SELECT seq, 'bad_timestamp' FROM parsed WHERE "timestamp" IS NULL""",
    "late_rows_found": """SELECT *, (SELECT count(*) FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders
                                       WHERE o_orderdate <= TIMESTAMP '2000-01-01 00:00:00')
                                     OR strftime(o_orderdate, '%Y-%m') IN ('1997-03', '1998-07')) AS second_run_rows FROM orders""",
    "migrate_transforms": """SELECT c_custkey AS id, c_acctbal AS balance, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band
                             FROM customer WHERE c_acctbal > 0""",
    "event_ingest_clustered": "WITH " + MSG + SINK_SELECT,
    "upsert_pruned": """SELECT o_orderkey, o_custkey, o_orderstatus,
                               CASE WHEN o_orderkey % 97 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                               o_orderdate, o_orderpriority FROM orders
                        UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
                        FROM orders WHERE o_orderkey % 97 = 5""",
    "upsert_pruned_stats": """SELECT 1 AS load, count(*) AS affected, true AS nothing_rewritten FROM orders
                              UNION ALL SELECT 2, count(*), true FROM orders WHERE o_orderkey % 97 = 5
                              UNION ALL SELECT 3, 2 * count(*), false FROM orders WHERE o_orderkey % 97 = 5""",
    "control_interleaved": f"""SELECT 'orders' AS table_name, strftime(max(o_orderdate), '{ISO}') AS hwm_value,
                               'timestamp_ntz' AS hwm_type FROM orders
                               UNION ALL SELECT 'events', strftime(max(ts), '{ISO}'), 'timestamp_ntz' FROM events
                               UNION ALL SELECT 'lineitem', strftime(max(l_shipdate), '{ISO}'), 'timestamp_ntz' FROM lineitem""",
    "initial_extract_nan": """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN NULL
                              ELSE p_retailprice END AS mark FROM part""",
    "migrate_key_only": """SELECT 1 AS run, 'ok' AS status, count(*) AS rows, CAST(0 AS BIGINT) AS failed, count(*) AS target_rows FROM part
                           UNION ALL SELECT 2, 'failed', count(*), count(*), count(*) FROM part
                           UNION ALL SELECT 3, 'failed', count(*), count(*), count(*) FROM part
                           UNION ALL SELECT 4, 'failed', 2 * count(*), 2 * count(*), 0 FROM part""",
    "csv_folder_raw": _CSV_RAW,
    "csv_file_counts": "SELECT file_name, count(*) AS records FROM (" + _CSV_RAW + ") GROUP BY file_name",
    "csv_folder_typed": _CSV_TYPED,
    "csv_raw_quoting": """SELECT 'odd.csv' AS file_name, CAST(n_nationkey AS VARCHAR) AS _c0, n_name || ' "q", x' AS _c1,
                          '' AS _c2, 'a' || chr(10) || 'b' AS _c3, CASE WHEN n_nationkey % 3 = 0 THEN 'tail' END AS _c4
                          FROM nation""",
    "csv_typed_conflict": """SELECT 'a.csv' AS file_name, CAST(n_nationkey AS VARCHAR) AS id, n_name AS v, CAST(NULL AS DOUBLE) AS w
                             FROM nation UNION ALL SELECT 'b.csv', 'n' || CAST(n_nationkey AS VARCHAR), NULL, n_regionkey + 0.5
                             FROM nation""",
    "csv_quoted_texts": """SELECT CAST(doc_id AS VARCHAR) AS _c0,
                           replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS _c1 FROM documents""",
    "csv_typed_lattice": """
        SELECT o_orderkey AS id, date_trunc('day', o_orderdate) AS at, CAST(o_orderkey AS DOUBLE) AS n, true AS flag,
               CAST(NULL AS VARCHAR) AS e, CAST(NULL AS VARCHAR) AS t, 'bigint' AS id_type, 'timestamp' AS at_type,
               'double' AS n_type, 'boolean' AS flag_type, 'string' AS e_type, 'string' AS t_type
        FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL
        SELECT o_orderkey + 10000000000, date_trunc('day', o_orderdate) + INTERVAL 630 MINUTE, o_orderkey + 0.5,
               CASE WHEN o_orderkey % 3 = 0 THEN false END, NULL, 'x,y', 'bigint', 'timestamp', 'double', 'boolean', 'string', 'string'
        FROM orders WHERE o_orderkey % 2 = 1""",
    "text_whole": _TEXT_WHOLE,
    "csv_text_combine": "SELECT out_name, line FROM (" + _COMBINE_ORDER + ")",
    "csv_text_combine_order": _COMBINE_ORDER,
}
