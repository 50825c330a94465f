"""Equivalent SQL (DuckDB dialect) for every registered query.

The driver runs each text on the same parquet tables and compares it with the
Spark result.  Fixed epochs, times and thresholds here are the same values the
Spark queries pass to the operators.
"""

from __future__ import annotations

# Shared fragments.
# L: the events table seen as a file listing (path, last_modified).
L = (
    "SELECT concat(event_type,'/u',CAST(user_id AS VARCHAR(20)),'/part_',"
    "CAST(event_id AS VARCHAR(20)),'.csv') AS path, ts AS last_modified FROM events"
)
# C: the orders columns.
C = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"
# R: orders with one 0/1 flag per rule (range, in_set, foreign_key).
R = (
    "SELECT o.*, CASE WHEN o_totalprice < 100000 THEN 1 ELSE 0 END AS v_range, "
    "CASE WHEN o_orderpriority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','4-LOW') THEN 1 ELSE 0 END AS v_set, "
    "CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END AS v_ref "
    "FROM orders o LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c "
    "ON o.o_custkey=c.c_custkey"
)
# A: the action text of a row.
A = (
    "concat_ws(',', CASE WHEN v_range=1 THEN 'quarantine' END, "
    "CASE WHEN v_set=1 THEN 'report' END, CASE WHEN v_ref=1 THEN 'failjob' END)"
)

# RL: lineitem with one 0/1 flag per rule of the lineitem rule set.
RL = (
    "SELECT l.*, CASE WHEN l_quantity < 1 OR l_quantity > 45 THEN 1 ELSE 0 END AS v1, "
    "CASE WHEN l_returnflag NOT IN ('A','N') THEN 1 ELSE 0 END AS v2, "
    "CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END AS v3, "
    "CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 1 ELSE 0 END AS v4, "
    "CASE WHEN l_suppkey IS NOT NULL AND s.s_suppkey IS NULL THEN 1 ELSE 0 END AS v5 "
    "FROM lineitem l LEFT JOIN (SELECT DISTINCT s_suppkey FROM supplier WHERE s_acctbal > 0) s "
    "ON l.l_suppkey = s.s_suppkey"
)
# AL: the action text of a lineitem row (the foreign-key rule has no action).
AL = (
    "NULLIF(concat_ws(',', CASE WHEN v1=1 THEN 'quarantine' END, CASE WHEN v2=1 THEN 'report' END, "
    "CASE WHEN v3=1 THEN 'quarantine,failjob' END, CASE WHEN v4=1 THEN 'failjob' END), '')"
)
# BL: a lineitem row is erroneous when a rule other than the reported one fails.
BL = "(v1+v3+v4+v5) > 0"


# RD: documents with one 0/1 flag per rule of the documents rule set.
RD = (
    "SELECT d.*, CASE WHEN text IS NULL OR trim(text) = '' THEN 1 ELSE 0 END AS v1, "
    "CASE WHEN length(text) < 20 OR length(text) > 20000 THEN 1 ELSE 0 END AS v2, "
    "CASE WHEN lang NOT IN ('en','de','fr') THEN 1 ELSE 0 END AS v3, "
    "CASE WHEN NOT (n_chars = length(text)) THEN 1 ELSE 0 END AS v4, "
    "CASE WHEN count(*) OVER (PARTITION BY doc_id) > 1 THEN 1 ELSE 0 END AS v5 FROM documents d"
)
# AD: actions in rule order, a repeated action kept at its first place.
AD = (
    "NULLIF(concat_ws(',', CASE WHEN v1=1 THEN 'quarantine' END, CASE WHEN v2=1 THEN 'report' END, "
    "CASE WHEN v1=0 AND v3=1 THEN 'quarantine' END, CASE WHEN v4+v5>0 THEN 'failjob' END), '')"
)


def _summary_row(strategy, check, column, flag, action, src="{RL}"):
    act = f"'{action}'" if action else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{strategy}' AS \"Strategy\", '{check}' AS \"Check\", '{column}' AS \"Column\", "
        f"CASE WHEN sum({flag})=0 THEN 'Passed' ELSE 'Failed' END AS \"Status\", "
        f"CAST(sum({flag}) AS BIGINT) AS \"Impacted_Records\", {act} AS \"Action_Taken\" FROM ({src}) r"
    )


def _profile_row(col):
    return (
        f"SELECT '{col}' AS column_name, count(*) AS row_count, count(*)-count({col}) AS null_count, "
        f"count(DISTINCT {col}) AS distinct_count, CAST(min({col}) AS VARCHAR) AS min_value, "
        f"CAST(max({col}) AS VARCHAR) AS max_value FROM part"
    )


def _numeric_row(col):
    return (
        f"SELECT '{col}' AS column_name, round(avg({col}),4) AS mean, round(stddev_samp({col}),4) AS stddev, "
        f"CAST(min({col}) AS DOUBLE) AS min_value, CAST(max({col}) AS DOUBLE) AS max_value FROM lineitem"
    )


_SQL = {
    "dq_lineitem_summary": " UNION ALL ".join(
        [
            _summary_row("Validity", "range", "l_quantity", "v1", "quarantine"),
            _summary_row("Validity", "in_set", "l_returnflag", "v2", "report"),
            _summary_row("Validity", "range", "l_discount", "v3", "quarantine,failjob"),
            _summary_row("Uniqueness", "unique", "l_orderkey,l_linenumber", "v4", "failjob"),
            _summary_row("Integrity", "foreign_key", "l_suppkey", "v5", None),
        ]
    ),
    "dq_lineitem_counts": (
        "SELECT count(*) AS source_count, count(*) FILTER (WHERE NOT {BL}) AS target_count, "
        "count(*) FILTER (WHERE {BL} AND v1+v3>0) AS quarantined_count, "
        "count(*) FILTER (WHERE {BL} AND v3+v4>0) AS fail_job_count FROM ({RL}) r"
    ),
    "dq_lineitem_erroneous": "SELECT l_orderkey, l_linenumber, l_suppkey, {AL} AS action FROM ({RL}) r WHERE {BL}",
    "dq_documents_summary": " UNION ALL ".join(
        [
            _summary_row("Completeness", "not_blank", "text", "v1", "quarantine", "{RD}"),
            _summary_row("Validity", "length", "text", "v2", "report", "{RD}"),
            _summary_row("Validity", "in_set", "lang", "v3", "quarantine", "{RD}"),
            _summary_row("Consistency", "expression", "n_chars", "v4", "failjob", "{RD}"),
            _summary_row("Uniqueness", "unique", "doc_id", "v5", "failjob", "{RD}"),
        ]
    ),
    "dq_documents_erroneous": "SELECT doc_id, lang, {AD} AS action FROM ({RD}) r WHERE v1+v3+v4+v5 > 0",
    "profile_part": " UNION ALL ".join(
        _profile_row(c) for c in ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    ),
    "profile_lineitem_numeric": " UNION ALL ".join(
        _numeric_row(c) for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
    "list_match_glob": "SELECT path,last_modified FROM ({L}) x WHERE starts_with(path,'click/') AND ends_with(path,'.csv')",
    "latest_file": "SELECT path,last_modified FROM ({L}) x WHERE starts_with(path,'click/') ORDER BY last_modified DESC, path LIMIT 1",
    "new_files_since": "SELECT path,last_modified FROM ({L}) x WHERE starts_with(path,'click/') AND last_modified > (SELECT max(last_modified) - INTERVAL '1' DAY FROM ({L}) y)",
    "advance_file_watermark": "SELECT max(last_modified) AS last_load_file_detail, count(*) AS source_file_count FROM ({L}) x WHERE starts_with(path,'click/')",
    "csv_read_explicit_schema": "SELECT {C} FROM orders",
    "stage_roundtrip": "SELECT {C} FROM orders",
    "stream_new_files": "SELECT {C} FROM orders",
    "select_columns": "SELECT o_orderkey,o_totalprice,o_orderdate FROM orders",
    "source_metrics": "SELECT count(*) AS source_row_count, CAST(6 AS BIGINT) AS source_column_count FROM orders",
    "empty_policy": "SELECT source_row_count, source_row_count=0 AS is_empty FROM (SELECT count(*) AS source_row_count FROM orders WHERE o_totalprice < 0) x UNION ALL SELECT count(*), count(*)=0 FROM orders",
    "transform_slot": "SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority, o_totalprice*2 AS doubled FROM orders WHERE o_orderstatus='F'",
    "source_table_name": "SELECT path, split_part(split_part(path,'/',-1),'.',1) AS table_name FROM ({L}) x",
    "dq_correct": "SELECT {C} FROM ({R}) r WHERE v_range+v_ref=0",
    "dq_erroneous": "SELECT {C},{A} AS action FROM ({R}) r WHERE v_range+v_ref>0",
    "dq_quarantine": "SELECT {C} FROM (SELECT {C},{A} AS action FROM ({R}) r WHERE v_range+v_ref>0) e WHERE regexp_matches(action,'quarantine')",
    "dq_failjob_gate": "SELECT count(*) AS fail_job_count, count(*)>0 AS blocked FROM (SELECT {A} AS action FROM ({R}) r) e WHERE regexp_matches(action,'failjob')",
    "dq_validation_summary": (
        "SELECT 'Validity' AS \"Strategy\",'range' AS \"Check\",'o_totalprice' AS \"Column\","
        "CASE WHEN sum(v_range)=0 THEN 'Passed' ELSE 'Failed' END AS \"Status\","
        "CAST(sum(v_range) AS BIGINT) AS \"Impacted_Records\",'quarantine' AS \"Action_Taken\" FROM ({R}) r "
        "UNION ALL SELECT 'Validity','in_set','o_orderpriority',CASE WHEN sum(v_set)=0 THEN 'Passed' ELSE 'Failed' END,"
        "CAST(sum(v_set) AS BIGINT),'report' FROM ({R}) r "
        "UNION ALL SELECT 'Integrity','foreign_key','o_custkey',CASE WHEN sum(v_ref)=0 THEN 'Passed' ELSE 'Failed' END,"
        "CAST(sum(v_ref) AS BIGINT),'failjob' FROM ({R}) r"
    ),
    "dq_not_null": "SELECT event_id, CASE WHEN event_type='error' THEN NULL ELSE value END AS value FROM events WHERE (CASE WHEN event_type='error' THEN NULL ELSE value END) IS NULL",
    "dq_unique": "SELECT l_orderkey,l_linenumber,n FROM (SELECT l_orderkey,l_linenumber,count(*) OVER (PARTITION BY l_orderkey,l_linenumber) AS n FROM lineitem) x WHERE n>1",
    "dq_regex": "SELECT p_partkey,p_brand FROM part WHERE NOT regexp_matches(p_brand,'^Brand#[1-3][0-9]$')",
    "dq_length": "SELECT p_partkey,p_name FROM part WHERE length(p_name) > 11",
    "dq_type": "SELECT p_partkey,raw FROM (SELECT p_partkey,CASE WHEN p_size > 40 THEN p_type ELSE CAST(p_size AS VARCHAR(10)) END AS raw FROM part) x WHERE raw IS NOT NULL AND try_cast(raw AS INT) IS NULL",
    "dq_expression": "SELECT l_orderkey,l_linenumber,l_discount,l_tax FROM lineitem WHERE NOT (l_discount >= l_tax)",
    "dq_execution_status": (
        "SELECT CASE WHEN q>0 AND j=0 THEN 'Passed with Quarantine Data' WHEN q>0 THEN 'Failed with Quarantine Data' "
        "WHEN j>0 THEN 'Failed with No Quarantine Data' ELSE 'Passed with No Quarantine Data' END AS dq_status "
        "FROM (SELECT sum(v_range) AS q, sum(v_ref) AS j FROM ({R}) r) s"
    ),
    "count_check_source_target": (
        "SELECT source_count,target_count,source_count=target_count AS source_target_table_count_validation "
        "FROM (SELECT (SELECT count(*) FROM orders) AS source_count,"
        "(SELECT count(*) FROM orders WHERE o_totalprice>=100000) AS target_count) k"
    ),
    "count_check_threshold": (
        "SELECT source_count,target_count,abs(source_count-target_count)*100 <= 10*source_count "
        "AS source_target_threshold_based_count_validation FROM (SELECT (SELECT count(*) FROM orders) AS source_count,"
        "(SELECT count(*) FROM orders WHERE o_totalprice>=100000) AS target_count) k"
    ),
    "count_check_control_file": (
        "SELECT c.o_orderstatus AS file_key,c.expected_count,a.actual_count,"
        "c.expected_count=coalesce(a.actual_count,0) AS source_target_control_file_based_count_validation "
        "FROM (SELECT o_orderstatus,count(*) AS expected_count FROM orders GROUP BY o_orderstatus) c "
        "LEFT JOIN (SELECT o_orderstatus,count(*) AS actual_count FROM orders WHERE o_totalprice>=100000 "
        "GROUP BY o_orderstatus) a ON c.o_orderstatus=a.o_orderstatus"
    ),
    "profile_columns": (
        "SELECT 'o_orderkey' AS column_name,count(*) AS row_count,count(*)-count(o_orderkey) AS null_count,"
        "count(DISTINCT o_orderkey) AS distinct_count,CAST(min(o_orderkey) AS VARCHAR(100)) AS min_value,"
        "CAST(max(o_orderkey) AS VARCHAR(100)) AS max_value FROM orders UNION ALL SELECT 'o_orderpriority',"
        "count(*),count(*)-count(o_orderpriority),count(DISTINCT o_orderpriority),min(o_orderpriority),"
        "max(o_orderpriority) FROM orders"
    ),
    "profile_numeric": (
        "SELECT 'o_totalprice' AS column_name,round(avg(o_totalprice),4) AS mean,"
        "round(stddev_samp(o_totalprice),4) AS stddev,min(o_totalprice) AS min_value,"
        "max(o_totalprice) AS max_value FROM orders"
    ),
    "first_load_current": "SELECT {C},100 AS epoch_id FROM orders",
    "list_files_of_a_folder": (
        "SELECT concat('landing/status=', o_orderstatus) AS folder, CAST(1 AS BIGINT) AS files FROM orders GROUP BY o_orderstatus"
    ),
    "file_metrics": (
        "SELECT count(*) AS source_row_count, count(DISTINCT o_orderstatus) AS source_file_count, true AS arrival_known FROM orders"
    ),
    "control_file_reconciliation": (
        "WITH a AS (SELECT concat('landing/status=', o_orderstatus) AS k, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY o_orderstatus), "
        "c AS (SELECT k, n + CASE WHEN s='O' THEN 1 ELSE 0 END AS e FROM a WHERE s IN ('F','O') UNION ALL SELECT 'landing/status=X', 7) "
        "SELECT coalesce(c.k, a.k) AS file_key, e AS expected_count, n AS actual_count, "
        "e IS NOT NULL AND e = coalesce(n, 0) AS source_target_control_file_based_count_validation "
        "FROM c FULL OUTER JOIN a ON c.k = a.k"
    ),
    "new_files_ledger": (
        "SELECT path, day AS last_modified FROM (SELECT path, date_trunc('day', last_modified) AS day, "
        "max(date_trunc('day', last_modified)) OVER () - INTERVAL '1' DAY AS mark, "
        "CAST(regexp_extract(path, 'part_([0-9]+)', 1) AS BIGINT) AS id FROM ({L}) x) y "
        "WHERE day > mark OR (day = mark AND id % 2 = 1)"
    ),
    "files_of_epoch": (
        "SELECT path AS file_key, day AS last_modified, CAST(1 AS BIGINT) AS row_count, 200 AS epoch_id FROM ("
        "SELECT path, date_trunc('day', last_modified) AS day, "
        "max(date_trunc('day', last_modified)) OVER () - INTERVAL '1' DAY AS mark, "
        "CAST(regexp_extract(path, 'part_([0-9]+)', 1) AS BIGINT) AS id FROM ({L}) x) y WHERE day = mark AND id % 2 = 0"
    ),
    "stored_watermark": (
        "SELECT CAST(7 AS BIGINT) AS workflow_id, CAST(1001 AS BIGINT) AS last_run_id, 'Failed' AS last_status, false AS active, "
        "CAST(100 AS BIGINT) AS last_epoch_id, strftime(max(last_modified), '%Y-%m-%d %H:%M:%S.%f') AS watermark "
        "FROM ({L}) x WHERE starts_with(path, 'click/')"
    ),
    "run_current": "SELECT {C},100 AS epoch_id FROM orders WHERE o_totalprice >= 100000",
    "run_stream_current": "SELECT {C} FROM orders WHERE o_totalprice >= 100000 AND o_orderstatus = 'F'",
    "quarantine_table": "SELECT {C},200 AS epoch_id FROM ({R}) r WHERE v_range=1",
    "run_reports": (
        "SELECT CAST(7 AS BIGINT) AS workflow_id, CAST(1000 AS BIGINT) AS run_id, count(*) AS source_row_count, "
        "count(CASE WHEN o_totalprice >= 100000 THEN 1 END) AS target_row_count, false AS empty, 'Success' AS w_status FROM orders "
        "UNION ALL SELECT 7, 1001, 0, 0, false, 'Failed'"
    ),
    "run_job_status_report": (
        "SELECT 'orders_feed' AS job_name, 'Success' AS w_status, count(*) AS source_row_count, "
        "count(CASE WHEN o_totalprice >= 100000 THEN 1 END) AS target_row_count, true AS has_zone FROM orders"
    ),
    "run_error_record": (
        "SELECT 'Read_from_source' AS step_name, 'success' AS step_completion_status, CAST(NULL AS VARCHAR) AS error_log "
        "UNION ALL SELECT 'DQ_Step', 'success', NULL UNION ALL SELECT 'Write_to_target', 'Failed', "
        "concat('Data not loaded to target: ', CAST(count(*) AS VARCHAR), ' rows have action failjob') FROM orders WHERE o_totalprice < 100000"
    ),
    "run_profile_report": (
        "SELECT 'o_orderkey' AS column_name,count(*) AS row_count,count(*)-count(o_orderkey) AS null_count,"
        "count(DISTINCT o_orderkey) AS distinct_count,CAST(min(o_orderkey) AS VARCHAR(100)) AS min_value,"
        "CAST(max(o_orderkey) AS VARCHAR(100)) AS max_value FROM orders UNION ALL SELECT 'o_orderpriority',count(*),"
        "count(*)-count(o_orderpriority),count(DISTINCT o_orderpriority),min(o_orderpriority),max(o_orderpriority) FROM orders"
    ),
    "run_table_source": (
        "SELECT {C}, CAST(year(o_orderdate) AS INT) AS o_year, 200 AS epoch_id FROM orders WHERE year(o_orderdate) >= 1996"
    ),
    "incremental_two_keys": (
        "SELECT k AS o_orderkey, o_custkey, o_orderdate FROM (SELECT *, floor(max(k) OVER () / 2) AS a, floor(max(o_custkey) OVER () * 0.9) AS b "
        "FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, o_custkey, o_orderdate FROM orders) x) y "
        "WHERE k > a OR o_custkey > b OR k IS NULL"
    ),
    "increment_marks_of_load": (
        "SELECT 'o_orderkey' AS key_column, CAST(max(o_orderkey) AS VARCHAR) AS value, 'bigint' AS data_type FROM orders "
        "UNION ALL SELECT 'o_orderdate', CAST(max(o_orderdate) AS VARCHAR), 'timestamp_ntz' FROM orders"
    ),
    "target_metrics": (
        "SELECT 100 AS epoch_id, count(*) AS target_row_count, 9 AS target_column_count, CAST(NULL AS INT) AS archived_epoch "
        "FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00' "
        "UNION ALL SELECT 200, count(*), 9, 100 FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'"
    ),
    "refresh_outside_partition": (
        "SELECT 100 AS epoch_id, count(*) AS rows FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00' "
        "UNION ALL SELECT 150, count(*) FROM orders WHERE o_orderstatus = 'P'"
    ),
    "dq_materialized": (
        "SELECT count(CASE WHEN v_range+v_ref=0 THEN 1 END) AS good_read, count(CASE WHEN v_range+v_ref>0 THEN 1 END) AS bad_read, "
        "count(*) AS row_count, count(CASE WHEN v_range+v_ref=0 THEN 1 END) AS good_count, "
        "CAST(sum(v_range) AS BIGINT) AS quarantined_count, CAST(sum(v_ref) AS BIGINT) AS failjob_count, "
        "CASE WHEN sum(v_range)>0 AND sum(v_ref)=0 THEN 'Passed with Quarantine Data' WHEN sum(v_range)>0 THEN 'Failed with Quarantine Data' "
        "WHEN sum(v_ref)>0 THEN 'Failed with No Quarantine Data' ELSE 'Passed with No Quarantine Data' END AS dq_status FROM ({R}) r"
    ),
    "run_log_compacted": (
        "SELECT user_id % 8 AS workflow_id, event_type AS step_name, count(*) AS records, max(event_id) AS newest_run, max(ts) AS newest "
        "FROM events GROUP BY user_id % 8, event_type"
    ),
    "profile_merged": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*)-count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem"
        for c in ("l_linenumber", "l_returnflag", "l_quantity", "l_discount")
    ),
    "drop_stage": "SELECT 'raw' AS kind, count(*) AS staged_rows, true AS dropped FROM orders",
    "replace_current": "SELECT {C},200 AS epoch_id FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'",
    "archive_history": "SELECT {C},100 AS epoch_id FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00'",
    "stamp_audit": (
        "SELECT o_orderkey,200 AS epoch_id,TIMESTAMP '2024-01-01 10:00:00' AS etl_create_date,"
        "TIMESTAMP '2024-01-01 10:00:00' AS etl_update_date FROM orders"
    ),
    "increment_high_water_mark": "SELECT 'o_orderkey' AS key_column,CAST(max(o_orderkey) AS VARCHAR(40)) AS value FROM orders",
    "incremental_extract": "SELECT o_orderkey,o_orderdate FROM orders WHERE o_orderkey > (SELECT CAST(max(o_orderkey)*0.9 AS BIGINT) FROM orders)",
    "next_run_id": "SELECT user_id AS workflow_id,coalesce(max(event_id)+1,1000) AS current_run_id FROM events GROUP BY user_id",
    "current_run_id": "SELECT user_id AS workflow_id,max(event_id) AS current_run_id FROM events GROUP BY user_id",
    "step_upsert_latest": (
        "SELECT workflow_id,step_name,run_details,step_completion FROM (SELECT user_id AS workflow_id,"
        "event_type AS step_name,props AS run_details,ts AS step_completion,row_number() OVER "
        "(PARTITION BY user_id,event_type ORDER BY ts DESC,event_id DESC) AS rn FROM events) x WHERE rn=1"
    ),
    "run_metrics_merge": (
        "SELECT user_id AS workflow_id,max(CASE WHEN event_type='view' THEN CAST(json_extract_string(props,'$.k') AS INT) END) "
        "AS source_row_count,max(CASE WHEN event_type='purchase' THEN CAST(json_extract_string(props,'$.k') AS INT) END) "
        "AS target_row_count FROM (SELECT e.*, row_number() OVER (PARTITION BY user_id,event_type ORDER BY ts DESC,"
        "event_id DESC) AS rn FROM events e) x WHERE rn=1 GROUP BY user_id"
    ),
    "workflow_state": (
        "SELECT workflow_id,last_step,last_run_date FROM (SELECT user_id AS workflow_id,event_type AS last_step,"
        "ts AS last_run_date,row_number() OVER (PARTITION BY user_id ORDER BY ts DESC,event_id DESC) AS rn "
        "FROM events) x WHERE rn=1"
    ),
    "workflow_status": (
        "SELECT user_id AS workflow_id,CASE WHEN max(CASE WHEN event_type='purchase' AND value>200 THEN 1 ELSE 0 END)=1 "
        "THEN 'Success' ELSE 'Failed' END AS w_status FROM events GROUP BY user_id"
    ),
    "schedule_step_join": (
        "SELECT c.c_custkey AS workflow_id,c.c_mktsegment AS schedule,e.event_type AS step_name,e.ts "
        "FROM customer c JOIN events e ON e.user_id=c.c_custkey"
    ),
    "report_job_status": (
        "SELECT c.c_custkey AS workflow_id,c.c_name AS job_name,s.n_source AS source_row_count,"
        "s.n_target AS target_row_count,CASE WHEN s.n_target>0 THEN 'Success' ELSE 'Failed' END AS w_status "
        "FROM customer c JOIN (SELECT user_id,count(*) AS n_source,count(CASE WHEN event_type='purchase' "
        "AND value>200 THEN 1 END) AS n_target FROM events GROUP BY user_id) s ON s.user_id=c.c_custkey"
    ),
    "report_times": "SELECT event_id, strftime(ts + INTERVAL '330' MINUTE, '%I:%M %p') AS local_time FROM events",
    "report_dq_counts": (
        "SELECT count(*) AS source_count,count(CASE WHEN v_range+v_ref=0 THEN 1 END) AS target_count,"
        "count(CASE WHEN v_range=1 THEN 1 END) AS quarantined_count FROM ({R}) r"
    ),
    "report_count_alerts": (
        "SELECT check_name,passed FROM (SELECT 'source_target_table_count_validation' AS check_name,true AS email,"
        "(SELECT count(*) FROM orders)=(SELECT count(*) FROM orders WHERE o_totalprice>=100000) AS passed "
        "UNION ALL SELECT 'source_target_threshold_based_count_validation',false,false) x WHERE email AND NOT passed"
    ),
}


def oracle_sql() -> dict[str, str]:
    return {
        k: v.replace("{RD}", RD).replace("{AD}", AD).replace("{RL}", RL).replace("{AL}", AL).replace("{BL}", BL)
        .replace("{L}", L).replace("{R}", R).replace("{A}", A).replace("{C}", C)
        for k, v in _SQL.items()
    }
