"""The audit log: appending, reading, completeness and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.operators import audit
from custodia.plans.registry import Inputs, fragment, query
from custodia.sources import dims

AS_OF = "2024-01-31 00:00:00"
_ADMINS = ", ".join(f"'{r}'" for r in dims.AUDIT_READ_ROLES)
fragment("log", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts, record_no) AS rn
  FROM #audit_input# WHERE user_id IS NOT NULL) x WHERE rn = 1""")
_ROW = "event_id, CAST(ts AS VARCHAR) AS ts, user_id, user_role, session_id, completion_tokens, latency_ms"


def shown(df):
    return df.select("event_id", F.col("ts").cast("string").alias("ts"), "user_id", "user_role", "session_id", "completion_tokens", "latency_ms")


def log(inp: Inputs):
    return audit.first_per_event(inp.view("audit_input"), ["ts", "record_no"])


@query("audit_append", f"""SELECT {_ROW} FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts, record_no) AS rn FROM #audit_input#
  WHERE user_id IS NOT NULL AND event_id NOT IN (SELECT event_id FROM #log# l WHERE ts < TIMESTAMP '2021-10-01 00:00:00')) x WHERE rn = 1""")
def audit_append(inp: Inputs):
    existing = log(inp).where("ts < TIMESTAMP '2021-10-01 00:00:00'")
    return shown(audit.new_rows(existing, inp.view("audit_input"), ["ts", "record_no"]))


@query("audit_dedupe", f"SELECT {_ROW} FROM #log# l")
def audit_dedupe(inp: Inputs):
    return shown(log(inp))


@query("audit_defaults", """SELECT record_no, CASE WHEN record_no % 2 = 0 THEN '' ELSE 'm1' END AS model_id, CASE WHEN record_no % 5 = 0 THEN 0 ELSE latency_ms END AS latency_ms,
  CASE WHEN record_no % 3 = 0 THEN 0 ELSE 1 END AS n_tool_calls FROM #audit_input#""")
def audit_defaults(inp: Inputs):
    partial = inp.view("audit_input").withColumns(
        {
            "model_id": F.when(F.col("record_no") % 2 != 0, "m1"),
            "latency_ms": F.when(F.col("record_no") % 5 != 0, F.col("latency_ms")),
            "tool_calls": F.when(F.col("record_no") % 3 != 0, F.array("tool_call")),
        }
    )
    return audit.with_defaults(partial).select("record_no", "model_id", "latency_ms", F.size("tool_calls").alias("n_tool_calls"))


@query("audit_count", "SELECT count(*) AS total FROM #log# l")
def audit_count(inp: Inputs):
    return log(inp).agg(F.count("*").alias("total"))


@query("audit_scan_page", f"SELECT {_ROW} FROM #log# l ORDER BY l.ts DESC, event_id DESC LIMIT 50 OFFSET 20")
def audit_scan_page(inp: Inputs):
    return shown(audit.page(log(inp), "SUPER_ADMIN", ["ts", "event_id"], limit=50, offset=20))


@query("audit_latest_k", f"SELECT {_ROW} FROM #log# l ORDER BY l.ts DESC, event_id DESC LIMIT 10")
def audit_latest_k(inp: Inputs):
    return shown(audit.page(log(inp), "PLATFORM_ADMIN", ["ts", "event_id"], limit=10))


@query("audit_sequence_id", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS id FROM #log# l")
def audit_sequence_id(inp: Inputs):
    return audit.with_sequence(log(inp).select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "id")


@query("audit_read_gate", f"SELECT DISTINCT user_id AS caller_id, user_role AS caller_role FROM #audit_input# WHERE user_role IN ({_ADMINS})")
def audit_read_gate(inp: Inputs):
    callers = inp.view("audit_input").select(F.col("user_id").alias("caller_id"), F.col("user_role").alias("caller_role"))
    return audit.readers_only(callers, "caller_role").distinct()


@query("audit_row_visibility", """SELECT c.caller_id, c.caller_role, c.caller_team, count(l.event_id) AS visible_rows
FROM (SELECT DISTINCT user_id AS caller_id, user_role AS caller_role, team AS caller_team FROM #audit_input# WHERE user_id IS NOT NULL) c
JOIN %role_permissions% p ON p.role = c.caller_role AND p.capability = 'view_audit'
LEFT JOIN #log# l ON p.access = 'full' OR (p.access = 'team' AND l.team = c.caller_team) OR (p.access = 'own' AND l.user_id = c.caller_id)
GROUP BY c.caller_id, c.caller_role, c.caller_team""")
def audit_row_visibility(inp: Inputs):
    callers = inp.view("audit_input").where("user_id IS NOT NULL").select(
        F.col("user_id").alias("caller_id"), F.col("user_role").alias("caller_role"), F.col("team").alias("caller_team")
    ).distinct()
    return audit.visible_counts(callers, log(inp), inp.dim("role_permissions"))


@query("retention_filter", f"SELECT {_ROW} FROM #audit_input# WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL '2' YEAR")
def retention_filter(inp: Inputs):
    return shown(audit.retained(inp.view("audit_input"), AS_OF))


@query("audit_completeness", """SELECT (SELECT count(*) FROM documents d WHERE concat('e', CAST(doc_id AS VARCHAR)) NOT IN (SELECT event_id FROM #log# l)) AS missing,
  count(*) AS audit_rows, CAST(sum(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_user, CAST(sum(CASE WHEN user_role IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_role,
  CAST(sum(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_ts, FALSE AS complete FROM #log# l""")
def audit_completeness(inp: Inputs):
    completions = inp.table("documents").select(F.concat(F.lit("e"), F.col("doc_id")).alias("event_id"))
    return audit.completeness(completions, log(inp))


@query("audit_immutability", """SELECT event_id, latency_ms FROM #log# l WHERE team IN ('team1', 'team3')""")
def audit_immutability(inp: Inputs):
    old = log(inp).select("event_id", "ts", "user_id", "latency_ms", "team")
    changed = F.when(F.col("team") == "team1", F.col("latency_ms") + 1).otherwise(F.col("latency_ms"))
    new = old.where("team <> 'team3'").withColumn("latency_ms", changed)
    return audit.altered_rows(old, new).select("event_id", "latency_ms")


@query("incident_impact", """SELECT count(*) AS requests, count(DISTINCT user_id) AS users FROM #traces# t
WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-10 18:00:00'""")
def incident_impact(inp: Inputs):
    return audit.impact(inp.view("traces"), "2024-01-10 06:00:00", "2024-01-10 18:00:00")
