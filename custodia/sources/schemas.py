"""Declared schemas of the tables the jobs read and write; nothing is inferred."""

from __future__ import annotations

PROMPTS = (
    "request_id STRING, prompt STRING, approved_datasets ARRAY<STRING>, approved_tools ARRAY<STRING>, "
    "user_id STRING, user_role STRING, session_id STRING, created_at TIMESTAMP"
)
CLAIMS = "request_id STRING, claims MAP<STRING, STRING>"
TOKEN_MAP = "token STRING, value STRING, type STRING, session_id STRING, created_at TIMESTAMP, expires_at TIMESTAMP"
AUDIT = (
    "event_id STRING, ts TIMESTAMP, user_id STRING, user_role STRING, session_id STRING, request_hash STRING, "
    "redacted_prompt_hash STRING, pii_tokens_present ARRAY<STRING>, model_id STRING, tool_calls ARRAY<STRING>, "
    "completion_tokens BIGINT, latency_ms BIGINT, response_hash STRING, compliance_flags ARRAY<STRING>"
)
COMPLETIONS = "request_id STRING, text STRING, model_id STRING, completion_tokens BIGINT, latency_ms BIGINT"
TRACES = (
    "request_id STRING, model_id STRING, task_type STRING, ttft_ms DOUBLE, total_latency_ms DOUBLE, tokens_per_second DOUBLE, "
    "prompt_tokens INT, completion_tokens INT, security_overhead_ms DOUBLE, self_consistency_score DOUBLE, grounding_score DOUBLE, "
    "judge_scores STRUCT<factual_accuracy: INT, completeness: INT, hallucination: INT, instruction_following: INT, notes: STRING>, "
    "timestamp TIMESTAMP"
)
GOLDEN = (
    "id STRING, task_type STRING, prompt STRING, context_chunks ARRAY<STRING>, reference_answer STRING, "
    "acceptable_range STRUCT<min_score: INT, required_facts: ARRAY<STRING>>, tags ARRAY<STRING>"
)
MESSAGES = (
    "message_id STRING, sender_agent STRING, recipient_agent STRING, task_type STRING, payload MAP<STRING, STRING>, "
    "context MAP<STRING, STRING>, trace_id STRING, created_at TIMESTAMP, ttl_seconds INT"
)
TOOL_CALLS = "call_id STRING, ts TIMESTAMP, trace_id STRING, agent STRING, tool STRING, params STRING, status STRING"
CHECK_RESULTS = "control_id STRING, evidence_group STRING, check STRING, passed BOOLEAN"
VERSIONS = "model_id STRING, version STRING, eval_score DOUBLE, hallucination_rate DOUBLE, deployed DATE"
