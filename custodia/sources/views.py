"""Domain tables (traces, prompts, messages, ...) derived from the test tables.

Each text runs unchanged in any ANSI engine once ``@table@`` is replaced, so an
independent engine can be given exactly the same inputs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_EVENTS = "(SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM @events@) e"

VIEWS: dict[str, str] = {
    "traces": f"""
SELECT event_id AS request_id, ts, concat('m', CAST(user_id % 3 AS STRING)) AS model_id,
  CASE event_type WHEN 'click' THEN 'tool_call' WHEN 'view' THEN 'rag_query' WHEN 'signup' THEN 'classification' ELSE 'generation' END AS task_type,
  user_id, k, value*9e0*CASE WHEN extract(DAY FROM ts) = 20 THEN 2e0 ELSE 1e0 END AS ttft_ms, value*60e0 AS total_latency_ms, value*4e0 AS queue_wait_ms, value AS security_overhead_ms,
  50+k AS prompt_tokens, 20+5*k+CASE WHEN event_id % 97 = 0 THEN 9000 ELSE 0 END AS completion_tokens,
  CASE WHEN extract(DAY FROM ts) = 15 THEN 0.5e0 ELSE 0.6e0 + 0.004e0*((event_id*7919) % 100) END AS self_consistency_score,
  1e0 - k/640e0 - CASE WHEN extract(DAY FROM ts) = 21 THEN 0.25e0 ELSE 0e0 END AS grounding_score,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status
FROM {_EVENTS}""",
    "prompts": """
SELECT doc_id AS request_id, text AS prompt, source AS session_id, concat('u', CAST(doc_id % 50 AS STRING)) AS user_id,
  CASE doc_id % 5 WHEN 0 THEN 'VIEWER' WHEN 1 THEN 'ANALYST' WHEN 2 THEN 'DEVELOPER' WHEN 3 THEN 'PLATFORM_ADMIN' ELSE 'SUPER_ADMIN' END AS user_role,
  TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' MINUTE AS created_at
FROM @documents@""",
    "messages": """
SELECT conv_id AS trace_id, turn AS seq, text,
  CASE role WHEN 'user' THEN 'INTAKE' WHEN 'assistant' THEN 'ORCHESTRATOR' ELSE 'ESCALATION' END AS sender,
  CASE (conv_id + turn) % 4 WHEN 0 THEN 'ORCHESTRATOR' WHEN 1 THEN 'RESEARCH' WHEN 2 THEN 'EXECUTION' ELSE 'ESCALATION' END AS recipient,
  CASE (conv_id * 3 + turn) % 5 WHEN 0 THEN 'route' WHEN 1 THEN 'research' WHEN 2 THEN 'execute' WHEN 3 THEN 'escalate' ELSE 'human_response' END AS message_type,
  TIMESTAMP '2024-01-01 00:00:00' + conv_id * INTERVAL '1' HOUR + turn * turn * INTERVAL '1' MINUTE AS created_at,
  300 AS ttl_seconds, ((conv_id * 37) % 100) / 100e0 AS intent_confidence
FROM @conversations@""",
    "tool_calls": f"""
SELECT event_id AS call_id, TIMESTAMP '2024-01-01 00:00:00' + ((event_id * 7) % 21600) * INTERVAL '1' SECOND AS ts, user_id AS trace_id,
  CASE user_id % 4 WHEN 0 THEN 'INTAKE' WHEN 1 THEN 'RESEARCH' WHEN 2 THEN 'EXECUTION' ELSE 'ESCALATION' END AS agent,
  CASE k % 10 WHEN 0 THEN 'jira_create_issue' WHEN 1 THEN 'jira_update_issue' WHEN 2 THEN 'jira_search' WHEN 3 THEN 'notion_create_page'
    WHEN 4 THEN 'notion_search' WHEN 5 THEN 'slack_post_message' WHEN 6 THEN 'slack_send_dm' WHEN 7 THEN 'jira_delete' WHEN 8 THEN 'calendar_write' ELSE 'notion_update_page' END AS tool,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status
FROM {_EVENTS}""",
    # an hour or less of requests at full load
    "load_requests": """
SELECT event_id AS request_id, TIMESTAMP '2024-01-01 00:00:00' + (event_id % 2400) * INTERVAL '1' SECOND AS ts FROM @events@""",
    "issues": """
SELECT o_orderkey AS issue_id, o_orderpriority AS project, o_orderstatus AS status, o_custkey AS assignee, o_orderdate AS updated_at FROM @orders@""",
    "responses_embedded": """
SELECT label AS prompt_id, vec_id AS response_id, embedding FROM @embeddings@""",
    "access_log": f"""
SELECT event_id AS request_id, ts, user_id,
  CASE WHEN k % 23 = 3 THEN '/v1/audit/' WHEN k % 29 = 5 THEN '/v2/prompt' WHEN k % 4 = 1 THEN '/v1/audit' WHEN k % 4 = 2 THEN '/health' ELSE '/v1/prompt' END AS path,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN 'Basic abc' ELSE concat('Bearer t', CAST(user_id AS STRING)) END AS authorization_header,
  CASE WHEN k % 13 = 0 THEN 'expired' ELSE 'valid' END AS token_status,
  CASE user_id % 7 WHEN 0 THEN 'VIEWER' WHEN 1 THEN 'ANALYST' WHEN 2 THEN 'DEVELOPER' WHEN 3 THEN 'PLATFORM_ADMIN' WHEN 4 THEN 'SUPER_ADMIN' WHEN 5 THEN 'HACKER' ELSE '' END AS x_user_role,
  CASE WHEN user_id % 14 = 6 THEN 'ANALYST' ELSE NULL END AS role_claim,
  CASE WHEN k % 5 = 0 THEN NULL ELSE concat('s', CAST(user_id AS STRING)) END AS sid, CASE WHEN k % 3 = 0 THEN 7200 ELSE 1800 END AS lifetime_s
FROM {_EVENTS}""",
    "audit_input": """
SELECT doc_id AS record_no, concat('e', CAST(doc_id % 150 AS STRING)) AS event_id, TIMESTAMP '2021-06-01 00:00:00' + doc_id * INTERVAL '36' HOUR AS ts,
  CASE WHEN doc_id % 41 = 0 THEN NULL ELSE concat('u', CAST(doc_id % 50 AS STRING)) END AS user_id, concat('team', CAST(doc_id % 4 AS STRING)) AS team,
  CASE doc_id % 4 WHEN 0 THEN 'ANALYST' WHEN 1 THEN 'DEVELOPER' WHEN 2 THEN 'PLATFORM_ADMIN' ELSE 'SUPER_ADMIN' END AS user_role, source AS session_id,
  concat('tool', CAST(doc_id % 3 AS STRING)) AS tool_call, n_chars AS completion_tokens, CASE WHEN doc_id < 150 THEN 10 ELSE 9999 END AS latency_ms
FROM @documents@""",
    "check_results": f"""
SELECT event_id AS check_id, CASE k % 6 WHEN 0 THEN 'G1' WHEN 1 THEN 'G2' WHEN 2 THEN 'G3' WHEN 3 THEN 'G4' WHEN 4 THEN 'RT1' ELSE 'RT2' END AS control_id,
  k % 3 AS evidence_group, k % 6 <> 4 AND event_type <> 'error' AS passed FROM {_EVENTS}""",
    # the console output of validation runs, one per user; lines of one run
    "run_output": f"""
SELECT user_id AS run_id, event_id AS line_no, concat('tests/validation/', CASE k % 9 WHEN 0 THEN 'Prompt_Injection::test_override' WHEN 1 THEN 'pii::test_PII_redact_email' WHEN 2 THEN 'pii::test_pii_in_retrieved'
    WHEN 3 THEN 'test_audit::test_append' WHEN 4 THEN 'load::test_latency_p99' WHEN 5 THEN 'red_team::test_indirect_injection' WHEN 6 THEN 'red_team::test_fake_token' WHEN 7 THEN 'red_team::test_token_smuggling' ELSE 'collected' END,
    CASE WHEN event_type = 'error' THEN ' FAILED' WHEN event_type = 'signup' THEN ' SKIPPED' ELSE ' PASSED' END) AS line FROM {_EVENTS}""",
    "validation_runs": """
SELECT user_id AS run_id, 'pytest tests/validation/' AS command, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS exit_code FROM @events@ GROUP BY user_id""",
    "judge": f"""
SELECT event_id AS request_id, concat('m', CAST(user_id % 3 AS STRING)) AS model_id,
  CASE WHEN k % 17 = 0 THEN 'not json' ELSE concat('{{"factual_accuracy": ', CAST(1 + k % 5 + CASE WHEN k % 19 = 0 THEN 5 ELSE 0 END AS STRING), ', "completeness": ', CAST(1 + (k * 3) % 5 AS STRING),
    ', "hallucination": ', CAST(1 + (k * 7) % 5 AS STRING), ', "instruction_following": ', CAST(1 + (k + 2) % 5 AS STRING), ', "notes": ""}}') END AS judge_json
FROM {_EVENTS}""",
    "pii_labelled": """
SELECT doc_id, concat('Ticket ', CAST(doc_id AS STRING), ' mail u', CAST(doc_id AS STRING), '@example.com ssn ', lpad(CAST(doc_id % 900 AS STRING), 3, '1'), '-45-6789.') AS text,
  length(CAST(doc_id AS STRING)) + 13 AS email_start, 2 * length(CAST(doc_id AS STRING)) + 31 AS ssn_start FROM @documents@""",
    "updates": f"""
SELECT event_id AS update_id, ts, user_id AS ticket_id, CASE WHEN (user_id + k) % 10 < CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 8 ELSE 3 END THEN 'human' ELSE 'agent' END AS actor_type FROM {_EVENTS}""",
    "tool_params": f"""
SELECT event_id AS call_id, CASE k % 10 WHEN 0 THEN 'jira_create_issue' WHEN 1 THEN 'jira_update_issue' WHEN 2 THEN 'jira_search' ELSE 'notion_search' END AS tool,
  CASE WHEN k % 3 = 0 THEN '{{"query": "x"}}' ELSE '{{"query": "x", "project_key": "p", "summary": "s", "issue_type": "b", "issue_key": "i", "jql_query": "j"}}' END AS params,
  k % 8 <> 0 AS orchestrator_approval, CASE WHEN k % 8 = 1 THEN NULL WHEN k % 8 = 2 THEN '{{"note": "orchestrator_approval: true"}}' WHEN k % 8 = 3 THEN '{{"orchestrator_approval": "true"}}'
    WHEN k % 8 = 0 THEN '{{"orchestrator_approval": false}}' WHEN k % 8 = 4 THEN 'orchestrator_approval: true' ELSE '{{"context": {{}}, "orchestrator_approval": true}}' END AS payload FROM {_EVENTS}""",
    "golden": """
SELECT item_id, text AS reference_answer, split_part(text, ' ', 2) AS fact1, regexp_extract(text, '([^ ]+)[ ]*$', 1) AS fact2, 4 AS min_score FROM @benchmark@""",
    "golden_runs": """
SELECT item_id, 'm0' AS model_id, 1 + (item_id * 3) % 5 AS score, CASE WHEN item_id % 11 = 3 THEN NULL WHEN item_id % 7 = 0 THEN upper(text) ELSE text END AS response FROM @benchmark@
UNION ALL
SELECT item_id, 'm1' AS model_id, 1 + (item_id * 3 + 1) % 5 AS score, CASE WHEN item_id % 13 = 5 THEN NULL WHEN (item_id + 1) % 7 = 0 THEN upper(text) ELSE text END AS response FROM @benchmark@""",
    # lists are comma separated, so that the text is valid in every engine
    "scoped": """
SELECT doc_id AS request_id, source AS session_id,
  CASE doc_id % 5 WHEN 0 THEN 'VIEWER' WHEN 1 THEN 'ANALYST' WHEN 2 THEN 'DEVELOPER' WHEN 3 THEN 'PLATFORM_ADMIN' ELSE 'SUPER_ADMIN' END AS user_role,
  concat('ds', CAST(doc_id % 4 AS STRING)) AS dataset,
  CASE doc_id % 3 WHEN 0 THEN 'ds0,ds1' WHEN 1 THEN 'ds2' ELSE '' END AS approved_datasets,
  CASE doc_id % 4 WHEN 0 THEN 'jira_search,notion_search' WHEN 1 THEN 'jira_search' ELSE '' END AS approved_tools,
  CASE doc_id % 7 WHEN 0 THEN 'jira_search' WHEN 1 THEN 'jira_search,jira_delete' WHEN 2 THEN 'notion_search' ELSE '' END AS tool_calls
FROM @documents@""",
    # one row per model and week: the version that ran then
    "versions": """
SELECT model_id, concat('v1.', CAST(wk AS STRING)) AS version, min(ts) AS deployed, round(avg(grounding_score), 6) AS eval_score,
  round(avg(CASE WHEN grounding_score < 0.85e0 THEN 1e0 ELSE 0e0 END), 6) AS hallucination_rate
FROM (SELECT *, CAST(extract(DAY FROM ts) AS INT) % 4 AS wk FROM #traces#) t
GROUP BY model_id, wk""",
}


def view_sql(name: str) -> str:
    """SQL of a view over the plain table names (what another engine runs)."""
    return _expand(VIEWS[name], lambda t: t)


def _expand(text: str, table) -> str:
    text = re.sub(r"#(\w+)#", lambda m: f"({_expand(VIEWS[m.group(1)], table)})", text)
    return re.sub(r"@(\w+)@", lambda m: table(m.group(1)), text)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(_expand(VIEWS[name], lambda t: f"parquet.`{sf_dir}/{t}.parquet`"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for CPU-heavy text work on an input of few splits.

    Only where the scan has at most half as many partitions as there are cores,
    so what is shuffled stays below half a split per core; a large table has
    splits enough and passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if 2 * df.rdd.getNumPartitions() <= cores:
        return df.repartition(cores)
    return df


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """File stream over one of the test tables, whether it is one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    source = spark.readStream.schema(schema)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return source.parquet(f"{sf_dir}/{name}.parquet")
    return source.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def stream_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over streams. Times become zoned, since watermarks refuse TIMESTAMP_NTZ."""
    used: dict[str, DataFrame] = {}

    def param(t: str) -> str:
        used[t] = stream(spark, sf_dir, t)
        return "@@" + t + "@@"

    text = _expand(VIEWS[name], param).replace("{", "{{").replace("}", "}}")
    df = spark.sql(re.sub(r"@@(\w+)@@", r"{\1}", text), **used)
    zoned = {f.name: df[f.name].cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(zoned) if zoned else df
