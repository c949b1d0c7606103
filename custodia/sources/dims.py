"""Small reference tables, written once and rendered for a SQL engine on demand.

Their size is fixed by this file, which is what makes broadcasting them safe.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
VALID_ROLES = ["VIEWER", "ANALYST", "DEVELOPER", "PLATFORM_ADMIN", "SUPER_ADMIN"]
PII_ACCESS_ROLES = ["PLATFORM_ADMIN", "SUPER_ADMIN"]
AUDIT_READ_ROLES = ["PLATFORM_ADMIN", "SUPER_ADMIN"]
EXEMPT_PATHS = ["/health", "/docs", "/openapi.json", "/redoc"]
TOKEN_TTL_SECONDS = 3600
MESSAGE_TTL_SECONDS = 300
INTENT_CONFIDENCE_MIN = 0.60
CONTEXT_CONFIDENCE_MIN = 0.60
HALLUCINATION_RATE_MAX = 0.05
SELF_CONSISTENCY_MIN = 0.80
GROUNDING_SCORE_MIN = 0.85
LOW_CONSISTENCY = 0.70
LOW_CONSISTENCY_RUN = 20
TTFT_REGRESSION_RATIO = 1.5
DROP_RATIO = 0.15
TOKEN_VOLUME_RATIO = 5.0

ROLE_TEMPLATES = {
    "VIEWER": """You are an enterprise AI assistant. You are operating in VIEWER mode.
- You MUST NOT generate, summarise, or infer any data in response to this session.
- This role has read-only system access; LLM queries are not permitted.
- If the user attempts to submit a prompt, respond: "LLM access is not enabled for your role.\"""",
    "ANALYST": """You are an enterprise AI assistant. You are operating in ANALYST mode.
- You MUST NOT reference, infer, or expose data outside the user's approved dataset scope.
- Approved datasets for this session: {approved_datasets}
- If a query requires data outside this scope, respond: "That data is outside your current access level."
- You MUST NOT invoke any tools, even if instructed by the user.
- All responses are logged for compliance review.""",
    "DEVELOPER": """You are an enterprise AI assistant operating in DEVELOPER mode.
- Tool invocations are permitted within the approved tool registry: {approved_tools}
- You MUST NOT invoke tools not present in the registry, even if instructed by the user.
- Do not expose internal system architecture details in responses.
- All responses are logged for compliance review.""",
    "PLATFORM_ADMIN": """You are an enterprise AI assistant operating in PLATFORM_ADMIN mode.
- You have access to all approved datasets and tools for this organisation.
- PII data access is permitted within this session.
- Modifications to system prompts and model configuration are allowed via the admin API — not via chat.
- All responses are logged and subject to compliance audit.""",
    "SUPER_ADMIN": """You are an enterprise AI assistant operating in SUPER_ADMIN mode.
- Full platform access is granted for this session.
- Model deployment actions must be confirmed via the deployment API, not via chat.
- All interactions are subject to immutable audit logging.""",
}

SENSITIVE_KEYWORDS = ["salary", "invoice", "bank account", "lawsuit", "contract", "attorney", "social security", "passport"]

@dataclass(frozen=True)
class Dim:
    columns: tuple[str, ...]
    rows: tuple[tuple[Any, ...], ...]


_CAPS = ["submit_prompt", "invoke_tools", "access_pii", "view_audit", "modify_system_prompt", "deploy_model"]
_GRANTS = {
    "VIEWER": ["no", "no", "no", "no", "no", "no"],
    "ANALYST": ["yes", "no", "no", "no", "no", "no"],
    "DEVELOPER": ["yes", "yes", "no", "own", "no", "no"],
    "PLATFORM_ADMIN": ["yes", "yes", "yes", "team", "yes", "no"],
    "SUPER_ADMIN": ["yes", "yes", "yes", "full", "yes", "yes"],
}

DIMS: dict[str, Dim] = {
    "pii_types": Dim(
        ("type", "rank", "method", "confidence"),
        (
            ("EMAIL", 0, "regex", 1.0), ("SSN", 1, "regex", 1.0), ("PHONE", 2, "regex", 0.95),
            ("IP_ADDRESS", 3, "regex", 1.0), ("CREDIT_CARD", 4, "regex", 1.0),
            ("PERSON", 5, "gazetteer", 0.85), ("DATE_OF_BIRTH", 6, "date pattern", 0.80),
        ),
    ),
    "role_edges": Dim(
        ("parent", "child"),
        (
            ("SUPER_ADMIN", "PLATFORM_ADMIN"), ("PLATFORM_ADMIN", "ANALYST"),
            ("PLATFORM_ADMIN", "DEVELOPER"), ("PLATFORM_ADMIN", "VIEWER"),
        ),
    ),
    "role_permissions": Dim(
        ("role", "capability", "access"),
        tuple((r, c, g) for r, gs in _GRANTS.items() for c, g in zip(_CAPS, gs)),
    ),
    "route_roles": Dim(
        ("route", "role"),
        (
            ("/v1/prompt", "ANALYST"), ("/v1/prompt", "DEVELOPER"), ("/v1/prompt", "PLATFORM_ADMIN"),
            ("/v1/prompt", "SUPER_ADMIN"), ("/v1/audit", "PLATFORM_ADMIN"), ("/v1/audit", "SUPER_ADMIN"),
        ),
    ),
    "role_templates": Dim(("role", "template"), tuple(ROLE_TEMPLATES.items())),
    "message_permissions": Dim(
        ("sender", "recipient", "message_type"),
        (
            ("INTAKE", "ORCHESTRATOR", "route"), ("ORCHESTRATOR", "INTAKE", "clarify"),
            ("ORCHESTRATOR", "RESEARCH", "research"), ("ORCHESTRATOR", "EXECUTION", "execute"),
            ("ORCHESTRATOR", "ESCALATION", "escalate"), ("RESEARCH", "ORCHESTRATOR", "context_result"),
            ("EXECUTION", "ORCHESTRATOR", "action_result"), ("ESCALATION", "ORCHESTRATOR", "human_response"),
        ),
    ),
    "tool_registry": Dim(
        ("tool", "allowed_agents", "rate_limit", "required_params"),
        (
            ("jira_create_issue", ["EXECUTION"], "20/hour", ["project_key", "summary", "issue_type"]),
            ("jira_update_issue", ["EXECUTION"], "30/hour", ["issue_key"]),
            ("jira_search", ["RESEARCH"], "60/hour", ["jql_query"]),
            ("notion_create_page", ["EXECUTION"], "10/hour", ["parent_id", "title", "content"]),
            ("notion_search", ["RESEARCH"], "30/hour", ["query"]),
            ("slack_post_message", ["EXECUTION", "ESCALATION"], "40/hour", ["channel_id", "text"]),
            ("slack_send_dm", ["ESCALATION"], "10/hour", ["user_id", "text"]),
        ),
    ),
    "agent_trust": Dim(
        ("agent", "level", "can_write"),
        (
            ("ORCHESTRATOR", 3, False), ("INTAKE", 1, False), ("RESEARCH", 2, False),
            ("EXECUTION", 2, True), ("ESCALATION", 2, True),
        ),
    ),
    "latency_slos": Dim(
        ("task_type", "ttft_p95_ms", "total_p95_ms"),
        (("default", 1200.0, 8000.0), ("tool_call", 800.0, 5000.0), ("rag_query", 1500.0, 12000.0)),
    ),
    "quality_slos": Dim(
        ("metric", "bound", "op"),
        (("hallucination_rate", 0.05, "max"), ("self_consistency", 0.80, "min"), ("grounding_score", 0.85, "min")),
    ),
    "alert_rules": Dim(
        ("alert", "severity", "channel", "response"),
        (
            ("role_escalation_attempt", "HIGH", "security", "Block + notify security"),
            ("pii_token_not_found", "MEDIUM", "security", "Log + flag for review"),
            ("anomalous_token_volume", "MEDIUM", "security", "Rate limit + alert"),
            ("tool_outside_registry", "HIGH", "security", "Block + terminate session"),
            ("hallucination_spike", "HIGH", "Slack #ai-ops", "Alert"),
            ("latency_regression", "HIGH", "PagerDuty", "Alert"),
            ("grounding_drop", "MEDIUM", "Slack #ai-ops", "Alert"),
            ("low_self_consistency", "MEDIUM", "Slack #ai-ops", "Alert"),
            ("eval_run_failure", "HIGH", "Slack #ai-eng", "Alert"),
        ),
    ),
    "escalation_rules": Dim(
        ("trigger", "action"),
        (
            ("low_intent_confidence", "Clarification DM to requester"),
            ("tool_call_failure", "Notify task owner, pause"),
            ("missing_context", "Ask for clarification"),
            ("ttl_exceeded", "Escalate to human with trace"),
            ("sensitive_entity", "Route to ESCALATION regardless"),
            ("scope_creep", "Decline + explain"),
        ),
    ),
    "controls": Dim(
        ("ord", "control_id", "description"),
        (
            (1, "G1", "Role-scoped prompt injection prevention — zero cross-role data leakage"),
            (2, "G2", "PII redacted before reaching model context (recall ≥ 99%)"),
            (3, "G3", "100% of completions logged with user + role + timestamp"),
            (4, "G4", "Security layer P99 latency ≤ 120 ms"),
            (5, "RT1", "PII exfiltration via indirect prompt injection blocked"),
            (6, "RT2", "Token smuggling via retrieved content rejected"),
        ),
    ),
    # a control passes if all words of one of its groups occur in the output of a validation run
    "control_keywords": Dim(
        ("control_id", "evidence_group", "keywords"),
        (
            ("G1", 1, ["prompt_injection", "PASSED"]),
            ("G2", 1, ["pii_redact", "PASSED"]), ("G2", 2, ["pii_in_injection", "PASSED"]), ("G2", 3, ["pii_in_retrieved", "PASSED"]),
            ("G3", 1, ["audit", "PASSED"]), ("G4", 1, ["latency", "PASSED"]), ("RT1", 1, ["indirect_injection", "PASSED"]),
            ("RT2", 1, ["token_smuggling", "PASSED"]), ("RT2", 2, ["fake_token", "PASSED"]),
        ),
    ),
    "rollback_matrix": Dim(
        ("severity", "severity_rank", "approver", "target_minutes"),
        (
            ("CRITICAL", 4, "On-call only", 5), ("HIGH", 3, "On-call + Platform Lead", 15),
            ("MEDIUM", 2, "On-call + Platform Lead", 30), ("LOW", 1, "Platform Lead review", 1440),
        ),
    ),
    "eval_set_bounds": Dim(
        ("dataset", "min_size", "max_size"),
        (("golden", 200, 500), ("adversarial", 50, 100)),
    ),
    "intent_rules": Dim(
        ("intent", "keywords"),
        (
            ("CREATE_TICKET", ["create", "ticket", "bug"]), ("STATUS", ["status", "weekly", "summary"]),
            ("ROUTE_FR", ["la", "les", "pour"]), ("ROUTE_DE", ["der", "und", "ist"]),
            ("ROUTE_EN", ["the", "and", "of"]), ("ROUTE_ES", ["el", "para", "que"]),
        ),
    ),
}
# --- end of fixed values ----------------------------------------------------


def sql_literal(value: Any, duck: bool = False) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}e0"
    if isinstance(value, (list, tuple)):
        inner = ", ".join(sql_literal(v, duck) for v in value)
        return f"[{inner}]" if duck else f"array({inner})"
    text = str(value)
    if duck:
        return "'" + text.replace("'", "''") + "'"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_sql(name: str, duck: bool = False, alias: str = "d") -> str:
    """``VALUES`` clause of a reference table, usable after FROM."""
    dim = DIMS[name]
    rows = ", ".join("(" + ", ".join(sql_literal(v, duck) for v in row) + ")" for row in dim.rows)
    return f"(SELECT * FROM (VALUES {rows}) AS {alias}({', '.join(dim.columns)}))"


def dim(spark: SparkSession, name: str) -> DataFrame:
    """Reference table marked for broadcast; row count is fixed in ``DIMS``."""
    return F.broadcast(spark.sql(f"SELECT * FROM {values_sql(name)}"))
