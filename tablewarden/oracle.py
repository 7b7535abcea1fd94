"""SQL twins of the registered queries, for an independent engine on the same tables.

``RELATIONS`` holds named subqueries; a query is a final SELECT over them and gets the ones it needs as
common table expressions.
"""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {}

# --- input relations (twins of adapters.py) --------------------------------------------------------

RELATIONS["in_runs"] = """
SELECT user_id AS job_id, event_id AS run_id,
       epoch_us(ts) // 1000 AS start_time,
       epoch_us(ts) // 1000 + CAST(round(value * 15000) AS BIGINT) AS end_time,
       CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'CANCELED' ELSE 'SUCCESS' END AS result_state,
       props AS state_message,
       'https://workspace/#job/' || user_id || '/run/' || event_id AS run_page_url
FROM events
"""

RELATIONS["in_jobs"] = """
SELECT c_custkey AS job_id, c_name AS name,
       CASE c_custkey % 6
         WHEN 0 THEN '0 ' || (c_custkey % 60) || ' ' || (c_custkey % 24) || ' * * ?'
         WHEN 1 THEN '0 ' || (c_custkey % 60) || ' ' || (c_custkey % 24) || ' ? * MON-FRI'
         WHEN 2 THEN '0 ' || (c_custkey % 60) || ' ' || (c_custkey % 24) || ' ? * 2,4'
         WHEN 3 THEN '0 ' || (c_custkey % 60) || ' ' || (c_custkey % 24) || ' 15 * ?'
         WHEN 4 THEN ''
         ELSE 'bad cron' END AS schedule
FROM customer
"""

_STORAGE_SCHEMA = "CASE WHEN {s} % 10 = 0 OR {s} % 2 = 1 THEN 'raw_schema' ELSE 'transform_schema' END"
_STORAGE_TABLE = "CASE WHEN {s} % 10 = 0 THEN 's_hot' ELSE 's_' || {s} || '_' || {b} END"
_BUCKET = "CASE WHEN l_orderkey % 16 = 0 THEN 0 WHEN l_orderkey % 16 <= 3 THEN 1 WHEN l_orderkey % 16 <= 8 THEN 2 ELSE 3 END"
_LINE_TABLE = f"""
       {_STORAGE_SCHEMA.format(s="l_suppkey")} AS table_schema,
       {_STORAGE_TABLE.format(s="l_suppkey", b="(" + _BUCKET + ")")} AS table_name"""

_LINE_BYTES = """CAST(floor(l_quantity * CASE l_suppkey % 5 WHEN 0 THEN 0.03::DOUBLE WHEN 1 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END
                  * 1048576) AS BIGINT)"""
RELATIONS["in_files"] = f"""
SELECT {_LINE_TABLE},
       {_LINE_BYTES} AS size_bytes
FROM lineitem
"""

RELATIONS["storage_tables"] = f"""
SELECT DISTINCT {_STORAGE_SCHEMA.format(s="s_suppkey")} AS table_schema,
       {_STORAGE_TABLE.format(s="s_suppkey", b="bucket")} AS table_name,
       CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey END AS supplier
FROM supplier, (VALUES (0), (1), (2), (3)) AS buckets(bucket)
"""

RELATIONS["in_props"] = """
SELECT table_schema, table_name, 'delta' AS format,
       CASE WHEN supplier % 4 = 0 THEN 'load_date' ELSE '' END AS partition_columns,
       CASE WHEN supplier % 3 = 0 THEN 'customer_id' ELSE '' END AS clustering_columns
FROM storage_tables
"""

RELATIONS["in_storage_columns"] = f"""
SELECT {_LINE_TABLE},
       (['created_date', 'Customer_Id', 'amount', 'account', 'region',
         'load_tmst', 'status', 'plan_number', 'updated_time', 'notes'])
         [CAST((l_suppkey + l_linenumber * (l_suppkey % 5 + 1)) % 10 + 1 AS INTEGER)] AS column_name,
       min(l_linenumber) AS ordinal_position
FROM lineitem GROUP BY 1, 2, 3
"""

_PART_SCHEMA = "CASE WHEN p_size % 2 = 1 THEN 'raw_schema' ELSE 'transform_schema' END"
_PART_TABLE = """
       CASE WHEN p_partkey % 11 = 0 THEN 'event_log_' WHEN p_partkey % 13 = 0 THEN '__materialization_' ELSE '' END
       || CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_')
               ELSE upper(replace(p_name, ' ', '_')) END
       || '_' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '_view' ELSE '' END"""

RELATIONS["part_tables"] = f"""
SELECT {_PART_SCHEMA} AS table_schema, {_PART_TABLE} AS table_name,
       CASE p_partkey % 5 WHEN 0 THEN 'MANAGED' WHEN 1 THEN 'EXTERNAL' WHEN 2 THEN 'VIEW'
            WHEN 3 THEN 'MATERIALIZED_VIEW' ELSE 'STREAMING_TABLE' END AS table_type,
       CASE WHEN p_partkey % 5 <> 2 THEN 'DELTA' END AS data_source_format,
       TIMESTAMP '2024-01-31' - to_days(p_size * 3 + 30) AS created,
       CASE WHEN p_partkey % 50 <> 0 THEN TIMESTAMP '2024-01-31' - to_days(p_size * 3) END AS last_altered
FROM part
"""

RELATIONS["part_columns"] = f"""
SELECT {_PART_SCHEMA} AS table_schema, {_PART_TABLE} AS table_name,
       CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN 'col ' || p_size WHEN 2 THEN lower(p_type)
            ELSE 'c_' || p_size END AS column_name,
       'STRING' AS full_data_type, 1 AS ordinal_position, 'YES' AS is_nullable
FROM part
"""

RELATIONS["platform_tables"] = """
SELECT * FROM part_tables
UNION ALL
SELECT table_schema, table_name, 'MANAGED', 'DELTA', TIMESTAMP '2023-01-01',
       TIMESTAMP '2024-01-31' - to_days(CAST(supplier AS INTEGER))
FROM storage_tables
"""

RELATIONS["in_views"] = """
SELECT 'transform_schema' AS table_schema, 'v_' || doc_id AS table_name,
       CASE doc_id % 4 WHEN 0 THEN 'SELECT * FROM publish_x.' WHEN 1 THEN 'SELECT * FROM publishXx.'
            WHEN 2 THEN 'SELECT * FROM raw_schema.t ' ELSE '' END || text AS view_definition
FROM documents
"""

_ORDER_KEY = "'r' || (o_custkey % 2) AS table_schema, 'tbl_' || o_custkey || '_' || (o_orderkey % 2) AS table_name"
_ORDER_COLUMNS = f"""{_ORDER_KEY}, 'col_' || (o_orderkey % 8) AS column_name,
       min(o_orderpriority) AS full_data_type, min(o_orderkey % 8) AS ordinal_position,
       max(o_orderstatus) AS is_nullable"""
_ORDER_TABLES = f"""{_ORDER_KEY},
       CASE o_custkey % 3 WHEN 0 THEN 'MANAGED' WHEN 1 THEN 'EXTERNAL' ELSE 'VIEW' END AS table_type,
       CASE WHEN o_custkey % 3 <> 2 THEN 'DELTA' END AS data_source_format,
       TIMESTAMP '2023-01-01' AS created, TIMESTAMP '2024-01-31' AS last_altered"""
_CURRENT = "o_orderdate >= TIMESTAMP '1998-01-01'"
_PREVIOUS = "o_orderdate < TIMESTAMP '1998-07-01'"
_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date"

RELATIONS["curr_columns"] = f"SELECT {_ORDER_COLUMNS} FROM orders WHERE {_CURRENT} GROUP BY 1, 2, 3"
RELATIONS["prev_columns"] = f"SELECT {_ORDER_COLUMNS} FROM orders WHERE {_PREVIOUS} GROUP BY 1, 2, 3"
RELATIONS["curr_tables"] = f"SELECT DISTINCT {_ORDER_TABLES} FROM orders WHERE {_CURRENT}"
RELATIONS["prev_tables"] = f"SELECT DISTINCT {_ORDER_TABLES} FROM orders WHERE {_PREVIOUS}"
RELATIONS["monthly_columns"] = f"SELECT {_MONTH}, {_ORDER_COLUMNS} FROM orders GROUP BY 1, 2, 3, 4"
RELATIONS["monthly_tables"] = f"SELECT DISTINCT {_MONTH}, {_ORDER_TABLES} FROM orders"

_SLOT = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 997 END"

RELATIONS["in_history"] = f"""
SELECT 'raw_schema' AS table_schema, 't_' || ({_SLOT}) AS table_name, event_id AS version,
       ts - to_days(CAST(({_SLOT}) % 120 AS INTEGER)) AS written,
       CASE event_type WHEN 'click' THEN 'WRITE' WHEN 'purchase' THEN 'merge' WHEN 'signup' THEN 'OPTIMIZE'
            WHEN 'view' THEN 'VACUUM END' ELSE 'SET TBLPROPERTIES' END AS operation,
       CASE WHEN event_type IN ('click', 'purchase') THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS rows_written
FROM events
"""

RELATIONS["history_tables"] = f"""
SELECT DISTINCT 'raw_schema' AS table_schema, 't_' || ({_SLOT}) AS table_name,
       CASE WHEN ({_SLOT}) % 7 = 3 THEN 'VIEW' ELSE 'MANAGED' END AS table_type,
       'DELTA' AS data_source_format, TIMESTAMP '2023-01-01' AS created, TIMESTAMP '2024-01-31' AS last_altered
FROM events
"""

_PART = "(CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END)"
_SOURCE = f"'source_catalog.r' || ({_PART} % 2) || '.tbl_' || {_PART} || '_' || (l_orderkey % 2)"

RELATIONS["in_edges"] = f"""
SELECT {_SOURCE} AS fqn,
       CASE l_returnflag WHEN 'A' THEN 'NOTEBOOK' WHEN 'R' THEN 'JOB' ELSE 'TABLE' END AS entity_type,
       CAST(l_suppkey AS VARCHAR) AS entity_id,
       CAST(l_shipdate + to_days(8218) AS DATE) AS event_date
FROM lineitem
"""

# A page spans 50 suppliers.
RELATIONS["payload"] = f"""
SELECT fqn, asset_kind, asset, row_number() OVER (PARTITION BY fqn, asset_kind, l_suppkey // 50 ORDER BY l_suppkey) AS pos
FROM (
SELECT DISTINCT {_SOURCE} AS fqn, kind AS asset_kind, l_suppkey,
       CASE kind WHEN 'NOTEBOOK' THEN '/Users/u' || l_suppkey || '/nb_u' || l_suppkey
                 WHEN 'JOB' THEN 'Customer#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
                 ELSE 's_' || l_suppkey END AS asset
FROM lineitem, (VALUES ('NOTEBOOK'), ('JOB'), ('DOWNSTREAM'), ('UPSTREAM')) AS kinds(kind)
WHERE CASE kind WHEN 'NOTEBOOK' THEN l_returnflag = 'A' WHEN 'JOB' THEN l_returnflag = 'R'
                WHEN 'DOWNSTREAM' THEN l_returnflag = 'N' ELSE l_returnflag = 'N' AND l_linestatus = 'F' END
) AS entities
"""

RELATIONS["in_audit"] = """
SELECT ts AS event_time, CAST(user_id AS VARCHAR) AS notebook_id,
       CASE WHEN user_id % 3 = 0 THEN '/Repos/r/' || user_id || '/nb_' || event_id END AS notebook_path
FROM events WHERE event_type = 'view'
"""

RELATIONS["in_listing"] = """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS object_id,
       CASE WHEN user_id % 2 = 0 THEN '/Users/u' || user_id || '/nb_u' || user_id
            ELSE '/Archive/u' || user_id || '/nb' END AS path
FROM events WHERE event_type = 'click' AND value >= 150
"""

# --- catalogue -------------------------------------------------------------------------------------

RELATIONS["all_tables"] = """
SELECT * FROM part_tables UNION ALL SELECT * FROM history_tables UNION ALL SELECT * FROM curr_tables
"""

RELATIONS["all_columns"] = """
SELECT table_schema, table_name, column_name, full_data_type, ordinal_position, is_nullable FROM part_columns
UNION ALL
SELECT table_schema, table_name, column_name, full_data_type, ordinal_position, is_nullable FROM curr_columns
"""

_UNRESERVED = "left(table_name, 17) <> '__materialization' AND left(table_name, 9) <> 'event_log'"

RELATIONS["inventory"] = f"""
SELECT * FROM platform_tables WHERE table_type IN ('MANAGED', 'EXTERNAL') AND {_UNRESERVED}
"""
RELATIONS["view_list"] = f"""
SELECT * FROM platform_tables WHERE table_type IN ('VIEW', 'MATERIALIZED_VIEW') AND {_UNRESERVED}
"""

_NIGHT = "o_orderdate >= make_timestamp(1997, 2 + night, 1, 0, 0, 0) AND o_orderdate < make_timestamp(1998, 2 + night, 1, 0, 0, 0)"
RELATIONS["night_orders"] = f"SELECT night, orders.* FROM orders, (VALUES (1), (2), (3)) AS nights(night) WHERE {_NIGHT}"
RELATIONS["night_tables"] = f"SELECT DISTINCT night, {_ORDER_KEY} FROM night_orders"
RELATIONS["night_columns"] = f"SELECT night, {_ORDER_COLUMNS} FROM night_orders GROUP BY 1, 2, 3, 4"
RELATIONS["night_table_changes"] = """
SELECT night, table_schema, table_name FROM night_tables
WHERE night > 1 AND (night - 1, table_schema, table_name) NOT IN (SELECT (night, table_schema, table_name) FROM night_tables)
UNION ALL
SELECT night + 1, table_schema, table_name FROM night_tables
WHERE night < 3 AND (night + 1, table_schema, table_name) NOT IN (SELECT (night, table_schema, table_name) FROM night_tables)
"""
RELATIONS["night_column_changes"] = """
SELECT night, table_schema, table_name, column_name
FROM (SELECT * FROM night_columns WHERE night > 1) AS c
FULL JOIN (SELECT * REPLACE (night + 1 AS night) FROM night_columns WHERE night < 3) AS p
  USING (night, table_schema, table_name, column_name)
WHERE (c.full_data_type IS NULL OR p.full_data_type IS NULL
       OR c.full_data_type <> p.full_data_type OR c.is_nullable <> p.is_nullable)
  AND (night, table_schema, table_name) IN (SELECT (night, table_schema, table_name) FROM night_tables)
  AND (night - 1, table_schema, table_name) IN (SELECT (night, table_schema, table_name) FROM night_tables)
"""
RELATIONS["nightly"] = """
SELECT CAST(make_date(1998, 2 + n.night, 1) AS VARCHAR) AS run_date,
       CASE WHEN n.night > 1 THEN CAST(make_date(1998, 1 + n.night, 1) AS VARCHAR) END AS compared_with,
       coalesce(t.changes, 0) AS table_changes, coalesce(c.changes, 0) AS column_changes
FROM (VALUES (1), (2), (3)) AS n(night)
LEFT JOIN (SELECT night, count(*) AS changes FROM night_table_changes GROUP BY night) AS t ON t.night = n.night
LEFT JOIN (SELECT night, count(*) AS changes FROM night_column_changes GROUP BY night) AS c ON c.night = n.night
"""

# --- storage ---------------------------------------------------------------------------------------

RELATIONS["detail"] = """
SELECT table_schema, table_name, format, size_bytes, files,
       round_even(size_bytes / 1048576.0::DOUBLE, 2) AS size_mb,
       CASE WHEN files > 0 THEN round_even(size_bytes / 1048576.0::DOUBLE / files, 3) ELSE 0.0::DOUBLE END AS avg_file_mb,
       partition_columns, clustering_columns,
       'source_catalog.' || table_schema || '.' || table_name AS fqn
FROM (
  SELECT p.*, CAST(coalesce(f.size_bytes, 0) AS BIGINT) AS size_bytes, coalesce(f.files, 0) AS files
  FROM in_props p
  LEFT JOIN (SELECT table_schema, table_name, sum(size_bytes) AS size_bytes, count(*) AS files
             FROM in_files GROUP BY 1, 2) f USING (table_schema, table_name)
) AS sized
"""

RELATIONS["small"] = """
SELECT table_schema, table_name, size_mb, files, avg_file_mb, fqn,
       CASE WHEN files > 1000 OR avg_file_mb < 1 THEN 'CRITICAL' WHEN files > 200 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       CAST(least(round_even((1.0::DOUBLE - least(avg_file_mb, 128.0::DOUBLE) / 128.0::DOUBLE) * 100, 0), 80) AS BIGINT) AS gain_pct,
       'OPTIMIZE ' || fqn || ';' AS cmd
FROM detail WHERE (files > 50 AND avg_file_mb < 32) OR files > 200
"""

RELATIONS["large_unclustered"] = """
SELECT table_schema, table_name, size_mb, files, partition_columns, fqn
FROM detail WHERE clustering_columns = '' AND size_mb > 100
"""

_DATE_LIKE = (
    "regexp_matches(k, 'summary_date|history_date|calendar_date|created_date|conversation_start"
    "|_date|_time|_tmst|created|_day')"
)
_ID_LIKE = (
    "regexp_matches(k, 'customer_number|client_iid|client_id|cust_|plan_number|rs_plan_number"
    "|_id|_key|_number|_iid|account')"
)

RELATIONS["cluster_keys"] = f"""
SELECT table_schema, table_name,
       CASE WHEN max(CASE WHEN is_date AND n = 1 THEN k END) IS NOT NULL
            THEN concat_ws(', ', max(CASE WHEN is_date AND n = 1 THEN k END),
                           max(CASE WHEN NOT is_date AND n = 1 THEN k END), max(CASE WHEN NOT is_date AND n = 2 THEN k END))
            ELSE concat_ws(', ', max(CASE WHEN n = 1 THEN k END), max(CASE WHEN n = 2 THEN k END),
                           max(CASE WHEN n = 3 THEN k END)) END AS rec_cols
FROM (
  SELECT *, row_number() OVER (PARTITION BY table_schema, table_name, is_date ORDER BY ordinal_position, k) AS n
  FROM (SELECT table_schema, table_name, ordinal_position, k, {_DATE_LIKE} AS is_date
        FROM (SELECT *, lower(column_name) AS k FROM in_storage_columns) AS c
        WHERE {_DATE_LIKE} OR {_ID_LIKE}) AS candidates
) AS ranked GROUP BY 1, 2
"""

RELATIONS["recommended"] = """
SELECT u.*, coalesce(k.rec_cols, '') AS rec_cols,
       CASE WHEN k.rec_cols IS NULL THEN '' ELSE 'ALTER TABLE ' || fqn || ' CLUSTER BY (' || k.rec_cols || ');' END AS alter_cmd,
       'OPTIMIZE ' || fqn || ';' AS opt_cmd
FROM large_unclustered u LEFT JOIN cluster_keys k USING (table_schema, table_name)
"""

RELATIONS["inventory_detail"] = """
SELECT i.table_schema, i.table_name, i.last_altered, d.size_mb, d.files, d.avg_file_mb, d.clustering_columns,
       d.table_name IS NOT NULL AS has_detail,
       CAST(i.last_altered AS DATE) < DATE '2023-12-02' AS stale
FROM inventory i LEFT JOIN detail d USING (table_schema, table_name)
"""

# --- jobs ------------------------------------------------------------------------------------------

RELATIONS["newest_runs"] = """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_time DESC, run_id DESC) AS n FROM in_runs
) AS numbered WHERE n <= 25
"""

RELATIONS["stats"] = """
SELECT job_id,
       round_even(sum(end_time - start_time)::DOUBLE / 60000 / count(*), 1) AS avg_min,
       round_even(max(end_time - start_time)::DOUBLE / 60000, 1) AS max_min,
       round_even(count(*) FILTER (result_state = 'FAILED')::DOUBLE / count(*) * 100, 1) AS fail_rate,
       count(*) FILTER (result_state = 'FAILED') AS n_failed, count(*) AS n_runs, max(start_time) AS last_ts
FROM newest_runs GROUP BY job_id
"""

# January: New York is five hours behind.
_ET = "strftime(epoch_ms({ms} - 18000000), '%Y-%m-%d %H:%M') || ' ET'"
_CLOCK = """
  CASE WHEN (job_id % 24) % 12 = 0 THEN 12 ELSE (job_id % 24) % 12 END || ':'
  || lpad(CAST(job_id % 60 AS VARCHAR), 2, '0') || CASE WHEN job_id % 24 < 12 THEN ' AM' ELSE ' PM' END"""

RELATIONS["labelled_jobs"] = f"""
SELECT job_id, name, schedule,
       CASE job_id % 6 WHEN 0 THEN 'Daily at ' || {_CLOCK}
                       WHEN 1 THEN 'Mon-Fri at ' || {_CLOCK}
                       WHEN 2 THEN 'Mon, Wed at ' || {_CLOCK}
                       WHEN 3 THEN 'Day 15 of month at ' || {_CLOCK}
                       WHEN 4 THEN 'No schedule' ELSE schedule END AS label
FROM in_jobs
"""

RELATIONS["summary"] = f"""
SELECT j.job_id, j.name AS job_name, j.schedule, j.label AS schedule_label,
       coalesce(avg_min, 0.0::DOUBLE) AS avg_min, coalesce(max_min, 0.0::DOUBLE) AS max_min,
       coalesce(fail_rate, 0.0::DOUBLE) AS fail_rate,
       coalesce(n_failed, 0) AS n_failed, coalesce(n_runs, 0) AS n_runs, coalesce(last_ts, 0) AS last_ts,
       CASE WHEN last_ts > 0 THEN {_ET.format(ms="last_ts")} ELSE 'Never' END AS last_run
FROM labelled_jobs j LEFT JOIN stats s USING (job_id)
"""

RELATIONS["failures"] = f"""
SELECT r.job_id, r.run_id, r.start_time, r.state_message AS error, r.run_page_url AS url,
       round_even((r.end_time - r.start_time)::DOUBLE / 60000, 1) AS duration,
       {_ET.format(ms="r.start_time")} AS date, j.name AS job_name
FROM in_runs r JOIN in_jobs j USING (job_id)
WHERE r.result_state = 'FAILED' AND r.start_time >= epoch_ms(TIMESTAMP '2024-01-30 05:00:00')
"""

_STALE_JOB = "last_ts < epoch_ms(TIMESTAMP '2024-01-31 05:00:00' - to_days(60))"

RELATIONS["cost"] = """
SELECT round_even(CAST(sum(CAST(avg_min AS DECIMAL(18,1))) AS DOUBLE) * 30 * 0.07::DOUBLE / 60, 2) AS est_monthly_cost,
       round_even(CAST(coalesce(sum(CAST(avg_min AS DECIMAL(18,1))) FILTER (avg_min > 10), 0) AS DOUBLE)
                  * 0.3::DOUBLE * 30 * 0.07::DOUBLE / 60, 2) AS est_savings
FROM summary
"""

RELATIONS["counters"] = f"""
SELECT * FROM
  (SELECT count(*) AS tables_analyzed,
          CAST(sum(CAST(size_mb AS DECIMAL(24,2))) AS DOUBLE) / 1024 AS total_gb,
          count(*) FILTER ((files > 50 AND avg_file_mb < 32) OR files > 200) AS small_file_tables,
          count(*) FILTER (clustering_columns = '' AND size_mb > 100) AS missing_cluster,
          count(*) FILTER (stale) AS stale_tables
   FROM inventory_detail WHERE has_detail) AS t,
  (SELECT count(*) AS views_analyzed,
          count(*) FILTER (CAST(last_altered AS DATE) < DATE '2023-12-02') AS stale_views FROM view_list) AS v,
  (SELECT count(*) AS jobs_analyzed, count(*) FILTER (avg_min > 10) AS long_running_jobs,
          count(*) FILTER (fail_rate > 20) AS failing_jobs, count(*) FILTER ({_STALE_JOB}) AS stale_jobs FROM summary) AS j,
  (SELECT count(*) AS period_failures FROM failures) AS f,
  cost
"""

# --- freshness and rules ---------------------------------------------------------------------------

RELATIONS["newest_history"] = """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY table_schema, table_name ORDER BY version DESC) AS n FROM in_history
) AS numbered WHERE n <= 30
"""

RELATIONS["stale_data"] = """
SELECT table_schema, table_name, 'source_catalog.' || table_schema || '.' || table_name AS fqn, 'DELTA' AS fmt,
       coalesce(strftime(written, '%Y-%m-%d %H:%M') || ' ET', 'No writes found') AS last_write,
       coalesce(operation, '—') AS last_op, coalesce(rows_written, '—') AS rows_written, days_since,
       CASE WHEN days_since > 90 THEN 'CRITICAL' WHEN days_since > 30 THEN 'HIGH' WHEN days_since > 14 THEN 'MEDIUM'
            ELSE 'LOW' END AS severity
FROM (
  SELECT t.table_schema, t.table_name, w.written, w.operation, w.rows_written,
         CASE WHEN w.written IS NULL THEN 9999
              ELSE CAST(floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(w.written)) / 86400000000) AS BIGINT)
         END AS days_since
  FROM (SELECT DISTINCT table_schema, table_name FROM in_history) t
  JOIN (SELECT * FROM history_tables WHERE table_type NOT IN ('VIEW', 'MATERIALIZED_VIEW')) b USING (table_schema, table_name)
  LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY table_schema, table_name ORDER BY version DESC) AS n
    FROM in_history WHERE upper(operation) IN ('WRITE', 'MERGE')
  ) w ON w.n = 1 AND w.table_schema = t.table_schema AND w.table_name = t.table_name
) AS aged WHERE days_since > 7
"""

_RAW_ISSUE = "CASE WHEN {n} <> lower({n}) THEN 'uppercase letters' ELSE 'contains spaces' END AS issue"
_RAW_BAD = "({n} <> lower({n}) OR contains({n}, ' '))"

RELATIONS["raw_tables"] = f"""
SELECT table_schema, table_name, {_RAW_ISSUE.format(n="table_name")}
FROM part_tables WHERE table_schema = 'raw_schema' AND {_RAW_BAD.format(n="table_name")}
"""
RELATIONS["raw_history_tables"] = f"""
SELECT table_schema, table_name, {_RAW_ISSUE.format(n="table_name")}
FROM history_tables WHERE table_schema = 'raw_schema' AND {_RAW_BAD.format(n="table_name")}
"""
RELATIONS["raw_columns"] = f"""
SELECT table_schema, table_name, column_name, {_RAW_ISSUE.format(n="column_name")}
FROM part_columns WHERE table_schema = 'raw_schema' AND {_RAW_BAD.format(n="column_name")}
"""
RELATIONS["transform_names"] = """
SELECT table_schema, table_name, table_type,
       CASE WHEN table_name <> lower(table_name) THEN 'uppercase letters' ELSE 'missing _view suffix' END AS issue
FROM part_tables
WHERE table_schema = 'transform_schema' AND (table_name <> lower(table_name) OR right(table_name, 5) <> '_view')
"""
RELATIONS["governance"] = """
SELECT table_schema, table_name, substring(view_definition, 1, 200) AS definition_preview
FROM in_views
WHERE view_definition NOT LIKE '%publish\\_%' ESCAPE '\\' AND view_definition NOT LIKE '%raw\\_schema%' ESCAPE '\\'
"""

# --- drift -----------------------------------------------------------------------------------------

RELATIONS["created_tables"] = """
SELECT table_schema, table_name, table_type, data_source_format FROM curr_tables
WHERE (table_schema, table_name) NOT IN (SELECT (table_schema, table_name) FROM prev_tables)
"""
RELATIONS["dropped_tables"] = """
SELECT table_schema, table_name, table_type, data_source_format FROM prev_tables
WHERE (table_schema, table_name) NOT IN (SELECT (table_schema, table_name) FROM curr_tables)
"""
RELATIONS["kept_tables"] = """
SELECT table_schema, table_name FROM curr_tables INTERSECT SELECT table_schema, table_name FROM prev_tables
"""
RELATIONS["created_columns"] = """
SELECT c.table_schema, c.table_name, c.column_name, c.full_data_type, c.is_nullable
FROM curr_columns c JOIN kept_tables USING (table_schema, table_name)
WHERE NOT EXISTS (SELECT 1 FROM prev_columns p WHERE p.table_schema = c.table_schema
                  AND p.table_name = c.table_name AND p.column_name = c.column_name)
"""
RELATIONS["dropped_columns"] = """
SELECT p.table_schema, p.table_name, p.column_name, p.full_data_type, p.is_nullable
FROM prev_columns p JOIN kept_tables USING (table_schema, table_name)
WHERE NOT EXISTS (SELECT 1 FROM curr_columns c WHERE p.table_schema = c.table_schema
                  AND p.table_name = c.table_name AND p.column_name = c.column_name)
"""
RELATIONS["altered_columns"] = """
SELECT c.table_schema, c.table_name, c.column_name, p.full_data_type AS old_type, c.full_data_type AS new_type,
       p.is_nullable AS old_nullable, c.is_nullable AS new_nullable
FROM curr_columns c JOIN prev_columns p USING (table_schema, table_name, column_name)
WHERE p.full_data_type <> c.full_data_type OR p.is_nullable <> c.is_nullable
"""
RELATIONS["diff"] = """
SELECT 'NEW TABLE' AS change_type, table_schema, table_name, NULL::VARCHAR AS column_name, table_type, data_source_format,
       NULL::VARCHAR AS old_type, NULL::VARCHAR AS new_type, NULL::VARCHAR AS old_nullable, NULL::VARCHAR AS new_nullable
FROM created_tables
UNION ALL
SELECT 'REMOVED', table_schema, table_name, NULL, table_type, data_source_format, NULL, NULL, NULL, NULL FROM dropped_tables
UNION ALL
SELECT 'COL ADDED', table_schema, table_name, column_name, NULL, NULL, NULL, full_data_type, NULL, is_nullable FROM created_columns
UNION ALL
SELECT 'COL REMOVED', table_schema, table_name, column_name, NULL, NULL, full_data_type, NULL, is_nullable, NULL FROM dropped_columns
UNION ALL
SELECT 'TYPE CHANGE', table_schema, table_name, column_name, NULL, NULL, old_type, new_type, old_nullable, new_nullable FROM altered_columns
"""
RELATIONS["changes"] = """
SELECT 'source_catalog.' || table_schema || '.' || table_name AS fqn, change_type, coalesce(column_name, '') AS col,
       CASE change_type
         WHEN 'COL ADDED' THEN new_type || ' | nullable=' || new_nullable
         WHEN 'COL REMOVED' THEN old_type
         WHEN 'TYPE CHANGE' THEN old_type || ' → ' || new_type || ' | nullable: ' || old_nullable || ' → ' || new_nullable
         ELSE table_type || ' | ' || coalesce(data_source_format, '—') END AS detail
FROM diff
UNION ALL
SELECT 'source_catalog.' || table_schema || '.' || table_name, 'NAMING', '', issue FROM raw_tables
UNION ALL
SELECT 'source_catalog.' || table_schema || '.' || table_name, 'NAMING', '', issue FROM raw_history_tables
UNION ALL
SELECT 'source_catalog.' || table_schema || '.' || table_name, 'NAMING', '', issue FROM transform_names
UNION ALL
SELECT 'source_catalog.' || table_schema || '.' || table_name, 'GOVERNANCE', '',
       'View does not reference publish_ or raw_schema' FROM governance
"""
RELATIONS["changed"] = """
SELECT fqn, string_agg(DISTINCT change_type, ', ' ORDER BY change_type) AS change_summary, count(*) AS n_changes,
       bool_or(change_type IN ('COL REMOVED', 'TYPE CHANGE')) AS breaking
FROM changes GROUP BY fqn
"""
RELATIONS["standards"] = """
SELECT (SELECT count(*) FROM raw_tables) + (SELECT count(*) FROM raw_history_tables) + (SELECT count(*) FROM raw_columns)
     + (SELECT count(*) FROM transform_names) + (SELECT count(*) FROM governance) AS standards_issues
"""

# --- lineage ---------------------------------------------------------------------------------------

RELATIONS["opens"] = """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY notebook_id ORDER BY event_time DESC, notebook_path DESC NULLS LAST) AS n
  FROM in_audit
) AS numbered WHERE n = 1
"""
RELATIONS["listed"] = "SELECT object_id, min(path) AS path FROM in_listing GROUP BY object_id"
RELATIONS["reads"] = """
SELECT fqn, entity_type, entity_id, count(*) AS n_reads
FROM in_edges
WHERE entity_type IN ('NOTEBOOK', 'JOB') AND event_date >= DATE '2024-01-01' AND fqn IN (SELECT fqn FROM changed)
GROUP BY 1, 2, 3
"""
_LAST = "regexp_extract({p}, '([^/]*)/*$', 1)"
_RESOLVED = f"""
SELECT i.entity_id, coalesce(o.notebook_path, l.path) AS notebook_path,
       coalesce({_LAST.format(p="coalesce(o.notebook_path, l.path)")}, 'Notebook #' || i.entity_id) AS notebook_name
FROM (SELECT DISTINCT entity_id FROM {{ids}}) i
LEFT JOIN opens o ON o.notebook_id = i.entity_id
LEFT JOIN listed l ON l.object_id = i.entity_id
"""
RELATIONS["user_ids"] = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity_id FROM events"
RELATIONS["resolved_users"] = _RESOLVED.format(ids="user_ids")
RELATIONS["resolved_reads"] = _RESOLVED.format(ids="reads")
RELATIONS["merged"] = f"""
SELECT fqn, asset_kind, asset FROM payload
WHERE asset_kind IN ('DOWNSTREAM', 'UPSTREAM') AND fqn IN (SELECT fqn FROM changed)
UNION ALL
SELECT DISTINCT * FROM (
  SELECT fqn, asset_kind, CASE asset_kind WHEN 'NOTEBOOK' THEN {_LAST.format(p="asset")} ELSE asset END AS asset
  FROM payload WHERE asset_kind IN ('NOTEBOOK', 'JOB') AND fqn IN (SELECT fqn FROM changed)
  UNION ALL
  SELECT r.fqn, 'NOTEBOOK', n.notebook_name FROM reads r JOIN resolved_reads n USING (entity_id)
  WHERE r.entity_type = 'NOTEBOOK'
  UNION ALL
  SELECT r.fqn, 'JOB', coalesce(j.name, 'Job #' || r.entity_id)
  FROM reads r LEFT JOIN in_jobs j ON CAST(j.job_id AS VARCHAR) = r.entity_id WHERE r.entity_type = 'JOB'
) AS readers
"""
RELATIONS["rated"] = """
SELECT fqn, change_summary, n_changes, breaking, n_downstream, n_upstream, n_notebooks, n_jobs, n_rejected,
       CASE WHEN breaking AND n_downstream >= 3 THEN 'CRITICAL' WHEN breaking AND n_downstream >= 1 THEN 'HIGH'
            WHEN n_downstream >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk
FROM (
  SELECT c.*, count(*) FILTER (asset_kind = 'DOWNSTREAM') AS n_downstream,
         count(*) FILTER (asset_kind = 'UPSTREAM') AS n_upstream,
         count(*) FILTER (asset_kind = 'NOTEBOOK') AS n_notebooks, count(*) FILTER (asset_kind = 'JOB') AS n_jobs,
         count(*) FILTER (asset_kind = 'REJECTED') AS n_rejected
  FROM changed c LEFT JOIN merged m USING (fqn) GROUP BY ALL
) AS counted
"""
_HOP = "'source_catalog.r' || ({k} % 2) || '.tbl_' || {k} || '_' || {p}"
_HOP_TARGET = "(CASE WHEN o_custkey < 10 THEN 9 - o_custkey WHEN o_orderkey % 2 = 0 THEN o_custkey // 2 ELSE o_custkey // 3 END)"
RELATIONS["hop_edges"] = f"""
SELECT DISTINCT {_HOP.format(k="o_custkey", p="(o_orderkey % 2)")} AS fqn, {_HOP.format(k=_HOP_TARGET, p="(o_orderkey // 2 % 2)")} AS asset
FROM orders
"""
# Paths of any length, shortest last; on the given tables none of the shortest has more than 30 edges.
RELATIONS["walks"] = """
SELECT fqn, asset, 1 AS distance FROM changed JOIN hop_edges USING (fqn)
UNION
SELECT w.fqn, e.asset, w.distance + 1 FROM walks w JOIN hop_edges e ON e.fqn = w.asset WHERE w.distance < 30
"""
RELATIONS["hops"] = "SELECT fqn, asset, min(distance) AS distance FROM walks WHERE asset <> fqn GROUP BY 1, 2"
RELATIONS["landed_pages"] = """
SELECT DISTINCT CASE WHEN page % 11 <> 5 THEN job_id END AS key, job_id, page,
       CASE page % 11 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'empty document' WHEN 3 THEN 'no document' WHEN 4 THEN 'unexpected shape'
         WHEN 5 THEN 'no key' END AS reason
FROM (SELECT user_id AS job_id, event_id // 100 AS page FROM events) AS numbered
"""
RELATIONS["assets"] = "SELECT count(*) AS affected_assets FROM merged WHERE asset_kind <> 'UPSTREAM'"

# --- queries ---------------------------------------------------------------------------------------

_SUMMARY_FIELDS = """'2024-01-31' AS run_date, tables_analyzed, views_analyzed, jobs_analyzed, small_file_tables,
  missing_cluster, long_running_jobs, failing_jobs, period_failures, stale_tables, stale_views, stale_jobs,
  est_monthly_cost, est_savings"""


def _top(section: str, relation: str, order: str, n: int, item: str, note: str, where: str = "TRUE") -> str:
    return f"""SELECT '{section}' AS section, rank, {item} AS item, {note} AS note
      FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {relation}) AS ranked WHERE rank <= {n} AND {where}"""


_NAME = "table_schema || '.' || table_name"
_SMALL_ORDER = "CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 ELSE 3 END, files DESC, fqn"
_OPTIMIZATION_REPORT = "\nUNION ALL\n".join(
    [
        _top("small_files", "small", _SMALL_ORDER, 15, _NAME, "severity"),
        _top("optimize_commands", "small", _SMALL_ORDER, 10, "cmd", "fqn"),
        _top("unclustered", "recommended", "size_mb DESC, fqn", 15, _NAME, "rec_cols"),
        _top("cluster_commands", "recommended", "size_mb DESC, fqn", 8, "alter_cmd || chr(10) || opt_cmd", "fqn", "alter_cmd <> ''"),
        _top("period_failures", "failures", "start_time DESC, run_id DESC", 20, "job_name",
             "concat_ws(' | ', date, CAST(run_id AS VARCHAR), substring(error, 1, 300))"),
        _top("stale_tables", "(SELECT * FROM inventory_detail WHERE stale) AS s", "last_altered, table_schema, table_name",
             15, _NAME, "CAST(last_altered AS VARCHAR)"),
        _top("stale_views", "(SELECT * FROM view_list WHERE CAST(last_altered AS DATE) < DATE '2023-12-02') AS s",
             "last_altered, table_schema, table_name", 15, _NAME, "CAST(last_altered AS VARCHAR)"),
        _top("stale_jobs", f"(SELECT * FROM summary WHERE {_STALE_JOB}) AS s", "last_ts, job_id", 15, "job_name",
             "schedule_label || ' | ' || last_run"),
    ]
)
_METADATA_REPORT = "\nUNION ALL\n".join(
    [
        _top("stale_data", "stale_data", "days_since DESC, fqn", 50, _NAME,
             "concat_ws(' | ', last_write, last_op, rows_written, CAST(days_since AS VARCHAR), severity)"),
        _top("raw_columns", "raw_columns", "table_name, column_name", 50, "table_name || '.' || column_name", "issue"),
        _top("transform_names", "transform_names", "table_name", 50, "table_name", "table_type || ' | ' || issue"),
        _top("governance", "governance", "table_name", 30, "table_name", "substring(definition_preview, 1, 120)"),
    ]
)

_SNAPSHOT_TEXT = """CAST(snapshot_date AS VARCHAR) AS snapshot_date, table_schema, table_name, column_name,
  full_data_type, CAST(ordinal_position AS BIGINT) AS ordinal_position, is_nullable, NULL::VARCHAR AS col_comment"""

FINAL: dict[str, str] = {
    "schema_diff": "SELECT * FROM diff",
    "schema_diff_by_digest": "SELECT * FROM diff",
    "interval_snapshots": " UNION ALL ".join(
        f"SELECT '{day}' AS snapshot_date, table_schema, table_name, column_name, full_data_type, CAST(ordinal_position AS BIGINT) AS ordinal_position, "
        f"is_nullable, NULL::VARCHAR AS col_comment, table_type, data_source_format FROM {when}_columns JOIN {when}_tables USING (table_schema, table_name)"
        for day, when in (("2024-01-30", "prev"), ("2024-01-31", "curr"), ("2024-02-01", "curr"))
    ),
    "new_tables": "SELECT * FROM created_tables",
    "removed_tables": "SELECT * FROM dropped_tables",
    "common_tables": "SELECT * FROM kept_tables",
    "added_columns": "SELECT * FROM created_columns",
    "removed_columns": "SELECT * FROM dropped_columns",
    "changed_columns": "SELECT * FROM altered_columns",
    "table_inventory": "SELECT table_schema, table_name, table_type, CAST(created AS VARCHAR) AS created, "
    "CAST(last_altered AS VARCHAR) AS last_altered FROM inventory",
    "view_inventory": "SELECT table_schema, table_name, table_type, CAST(created AS VARCHAR) AS created, "
    "CAST(last_altered AS VARCHAR) AS last_altered FROM view_list",
    "table_snapshot": "SELECT '2024-01-31' AS snapshot_date, table_schema, table_name, table_type, data_source_format, "
    "CAST(created AS VARCHAR) AS created, CAST(last_altered AS VARCHAR) AS last_altered FROM all_tables",
    "column_snapshot": f"SELECT {_SNAPSHOT_TEXT} FROM (SELECT '2024-01-31' AS snapshot_date, * FROM all_columns) AS c",
    "base_tables": "SELECT table_schema, table_name FROM all_tables WHERE table_type NOT IN ('VIEW', 'MATERIALIZED_VIEW')",
    "previous_snapshot_date": "SELECT CAST(max(snapshot_date) AS VARCHAR) AS prev_date FROM monthly_columns "
    "WHERE snapshot_date < DATE '1998-06-01'",
    "snapshot_at": f"SELECT {_SNAPSHOT_TEXT} FROM monthly_columns WHERE snapshot_date = DATE '1998-06-01'",
    "snapshot_roundtrip": f"SELECT {_SNAPSHOT_TEXT}, table_type, data_source_format, CAST(created AS VARCHAR) AS created, "
    "CAST(last_altered AS VARCHAR) AS last_altered FROM monthly_columns LEFT JOIN monthly_tables "
    "USING (snapshot_date, table_schema, table_name) WHERE snapshot_date >= DATE '2001-08-01' - 90",
    "file_inventory": f"""SELECT table_schema, table_name, 's3://lake/warehouse/' || table_schema || '/' || table_name || '/part-' || l_orderkey || '-' || l_linenumber
      || '.parquet' AS file_path, size_bytes, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS modified
      FROM (SELECT l_orderkey, l_linenumber, l_shipdate, {_LINE_TABLE}, {_LINE_BYTES} AS size_bytes FROM lineitem) AS f WHERE size_bytes % 7 <> 0 AND size_bytes % 5 <> 0""",
    "storage_detail": "SELECT * EXCLUDE (fqn) FROM detail",
    "small_files": "SELECT * FROM small",
    "unclustered": "SELECT * FROM large_unclustered",
    "recommend_clustering": "SELECT * FROM recommended",
    "stale_tables": "SELECT table_schema, table_name, size_mb, CAST(last_altered AS VARCHAR) AS last_altered, has_detail "
    "FROM inventory_detail WHERE stale",
    "stale_views": "SELECT table_schema, table_name, table_type, CAST(last_altered AS VARCHAR) AS last_altered "
    "FROM view_list WHERE CAST(last_altered AS DATE) < DATE '2023-12-02'",
    "jobs_from_payload": "SELECT * FROM in_jobs WHERE name <> 'Customer#000000007'",
    "runs_from_payload": "SELECT * FROM in_runs",
    "latest_runs": "SELECT * FROM newest_runs",
    "run_stats": "SELECT * FROM stats",
    "job_summary": "SELECT * FROM summary",
    "long_running_jobs": "SELECT * FROM summary WHERE avg_min > 10",
    "failing_jobs": "SELECT *, n_failed || '/' || n_runs AS failed_of_total FROM summary WHERE fail_rate > 20",
    "stale_jobs": f"SELECT * FROM summary WHERE {_STALE_JOB}",
    "period_failures": "SELECT * FROM failures",
    "streamed_period_failures": "SELECT * FROM failures",
    "streamed_freshness": "SELECT * FROM stale_data",
    "rejected_documents": "SELECT 'runs' AS source, CAST(key AS VARCHAR) AS key, reason, count(*) AS documents FROM landed_pages "
    "WHERE reason IS NOT NULL GROUP BY ALL",
    "landing_totals": "SELECT 'runs' AS source, count(*) AS landed, count(*) - count(reason) AS accepted, count(reason) AS rejected, "
    "count(*) FILTER (reason = 'no document') AS no_document, count(*) FILTER (reason = 'empty document') AS empty_document, "
    "count(*) FILTER (reason = 'not JSON') AS not_json, count(*) FILTER (reason = 'unexpected shape') AS unexpected_shape, "
    "count(*) FILTER (reason = 'no key') AS no_key FROM landed_pages",
    "downstream_hops": "SELECT * FROM hops",
    "impact_depth": "SELECT c.fqn, change_summary, breaking, count(*) FILTER (distance = 1) AS n_direct, count(distance) AS n_reached, "
    "coalesce(max(distance), 0) AS deepest FROM changed c LEFT JOIN hops USING (fqn) GROUP BY ALL",
    "schedule_labels": "SELECT job_id, schedule, label FROM labelled_jobs",
    "cost_estimate": "SELECT * FROM cost",
    "lookback_start": "SELECT CAST(max(CAST(ts - INTERVAL 5 HOUR AS DATE)) AS VARCHAR) AS lookback_start FROM events "
    "WHERE CAST(ts - INTERVAL 5 HOUR AS DATE) < DATE '2024-01-31'",
    "nightly_changes": "SELECT * FROM nightly",
    "recent_history": "SELECT table_schema, table_name, version, operation, rows_written, "
    "rtrim(rtrim(strftime(written, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS timestamp FROM newest_history",
    "data_freshness": "SELECT * FROM stale_data",
    "raw_table_violations": "SELECT * FROM raw_tables",
    "raw_column_violations": "SELECT * FROM raw_columns",
    "raw_column_violations_all": "SELECT * FROM raw_columns",
    "transform_name_violations": "SELECT * FROM transform_names",
    "transform_name_violations_all": "SELECT * FROM transform_names",
    "view_governance_violations": "SELECT * FROM governance",
    "view_governance_violations_all": "SELECT * FROM governance",
    "lineage_from_payload": "SELECT fqn, asset_kind, pos, asset FROM payload",
    "latest_audit": "SELECT notebook_id, notebook_path, "
    "rtrim(rtrim(strftime(event_time, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS event_time FROM opens",
    "workspace_paths": "SELECT * FROM listed",
    "resolve_notebooks": "SELECT * FROM resolved_users",
    "unresolved_notebooks": "SELECT entity_id FROM resolved_users WHERE notebook_path IS NULL",
    "resolve_jobs": "SELECT DISTINCT entity_id, coalesce(name, 'Job #' || entity_id) AS job_name "
    "FROM in_edges LEFT JOIN in_jobs ON CAST(job_id AS VARCHAR) = entity_id WHERE entity_type = 'JOB'",
    "platform_totals": "SELECT tables_analyzed AS tables, total_gb, views_analyzed AS views, jobs_analyzed AS jobs, "
    "small_file_tables + missing_cluster + failing_jobs AS issues FROM counters",
    "optimization_dashboard": "SELECT small_file_tables, missing_cluster, failing_jobs, period_failures, est_savings FROM counters",
    "run_summary": f"SELECT {_SUMMARY_FIELDS} FROM counters",
    "tracker_roundtrip": f"SELECT {_SUMMARY_FIELDS} FROM counters",
    "change_log": "SELECT * FROM changes",
    "change_summary": "SELECT * FROM changed",
    "change_totals": "SELECT (SELECT count(*) FROM diff) AS schema_changes, standards_issues FROM standards",
    "access_lineage": "SELECT * FROM reads",
    "merge_lineage": "SELECT * FROM merged",
    "impact_risk": "SELECT * FROM rated",
    "affected_assets": "SELECT * FROM assets",
    "affected_distinct": "SELECT count(DISTINCT asset) FILTER (asset_kind = 'NOTEBOOK') AS notebooks, "
    "count(DISTINCT asset) FILTER (asset_kind = 'JOB') AS jobs FROM merged",
    "metadata_dashboard": "SELECT (SELECT count(*) FROM created_tables) AS new_tables, "
    "(SELECT count(*) FROM dropped_tables) AS removed_tables, (SELECT count(*) FROM created_columns) AS cols_added, "
    "(SELECT count(*) FROM dropped_columns) + (SELECT count(*) FROM altered_columns) AS cols_modified, "
    "standards_issues, affected_assets, (SELECT count(*) FROM stale_data) AS stale_tables, 0::BIGINT AS rejected_documents, '2024-01-30' AS compared_with "
    "FROM standards, assets",
    "report_sections_optimization": _OPTIMIZATION_REPORT,
    "report_sections_metadata": _METADATA_REPORT,
}


def _needed(sql: str) -> list[str]:
    """Relations that ``sql`` reads, each after the ones it reads itself."""
    order: list[str] = []
    open_: list[str] = []  # a recursive relation reads itself

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN|,)\s+(\w+)|^\s+(\w+)\s*$", text, flags=re.MULTILINE):
            relation = name[0] or name[1]
            if relation in RELATIONS and relation not in order and relation not in open_:
                open_.append(relation)
                visit(RELATIONS[relation])
                open_.remove(relation)
                if relation not in order:
                    order.append(relation)

    visit(sql)
    return order


def oracle_sql() -> dict[str, str]:
    queries = {}
    for name, final in FINAL.items():
        relations = _needed(final)
        prologue = ",\n".join(f"{r} AS ({RELATIONS[r].strip()})" for r in relations)
        recursive = "RECURSIVE " if "walks" in relations else ""
        queries[name] = f"WITH {recursive}{prologue}\n{final}" if relations else final
    return queries
