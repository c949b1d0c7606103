"""Roles, routes, scopes and system prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.operators import access
from custodia.plans.registry import Inputs, fragment, query
from custodia.sources import dims

_VALID = ", ".join(f"'{r}'" for r in dims.VALID_ROLES)
fragment("claims", """SELECT *, CASE WHEN coalesce(x_user_role, '') <> '' THEN x_user_role ELSE role_claim END AS claim_role,
  coalesce(sid, '') AS claim_session FROM #access_log#""")


def claims(inp: Inputs):
    log = inp.view("access_log").withColumnRenamed("user_id", "sub")
    return access.project_claims(log, "x_user_role", "role_claim", "sub", "sid")


@query("prompt_scan", """SELECT doc_id AS request_id, length(text) AS prompt_chars, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS n_datasets,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS approved_datasets FROM documents""")
def prompt_scan(inp: Inputs):
    raw = inp.table("documents").select(
        F.col("doc_id").alias("request_id"), F.col("text").alias("prompt"),
        F.when(F.col("doc_id") % 3 != 0, F.array("source")).alias("approved_datasets"),
    )
    lists = F.coalesce("approved_datasets", F.expr("cast(array() as array<string>)"))
    return raw.select(
        "request_id", F.length("prompt").cast("bigint").alias("prompt_chars"), F.size(lists).alias("n_datasets"),
        F.array_join(lists, ",").alias("approved_datasets"),
    )


@query("claims_project", """SELECT request_id, claim_role AS user_role, CAST(user_id AS VARCHAR) AS user_id, claim_session AS session_id FROM #claims# c""")
def claims_project(inp: Inputs):
    return claims(inp).select("request_id", "user_role", "user_id", "session_id")


@query("valid_role_filter", f"SELECT request_id, claim_role AS user_role FROM #claims# c WHERE claim_role IN ({_VALID})")
def valid_role_filter(inp: Inputs):
    return claims(inp).where(access.valid_role(F.col("user_role"))).select("request_id", "user_role")


@query("access_decision", f"""SELECT request_id, CASE WHEN path = '/health' THEN 200 WHEN coalesce(authorization_header, '') NOT LIKE 'Bearer %' THEN 401
  WHEN token_status <> 'valid' THEN 401 WHEN claim_role IS NULL OR claim_role NOT IN ({_VALID}) THEN 403
  WHEN path NOT IN (SELECT route FROM %route_roles% q) THEN 404 WHEN r.role IS NULL THEN 403 ELSE 200 END AS status,
  CASE WHEN coalesce(authorization_header, '') LIKE 'Bearer %' THEN substr(authorization_header, 8) END AS token
FROM #claims# c LEFT JOIN %route_roles% r ON r.route = c.path AND r.role = c.claim_role""")
def access_decision(inp: Inputs):
    decided = access.decide(
        claims(inp), inp.dim("route_roles"), "path", "authorization_header", F.col("token_status") == "valid", "user_role"
    )
    return decided.select("request_id", "status", access.bearer_token(F.col("authorization_header")).alias("token"))


@query("endpoint_role_gate", """SELECT c.request_id, c.path, c.claim_role AS user_role FROM #claims# c JOIN %route_roles% r ON r.route = c.path AND r.role = c.claim_role""")
def endpoint_role_gate(inp: Inputs):
    return access.require_role(claims(inp), inp.dim("route_roles"), "path", "user_role").select("request_id", "path", "user_role")


@query("jwt_lifetime_check", "SELECT request_id, CAST(lifetime_s AS BIGINT) AS lifetime_s FROM #access_log# WHERE lifetime_s > 3600")
def jwt_lifetime_check(inp: Inputs):
    iat = F.unix_seconds(F.col("ts").cast("timestamp"))
    tokens = inp.view("access_log").select("request_id", iat.alias("iat"), (iat + F.col("lifetime_s")).alias("exp"))
    return tokens.where("exp - iat > 3600").select("request_id", F.expr("exp - iat").alias("lifetime_s"))


@query("capability_check", """SELECT p.request_id, p.user_role, s.access AS submit_prompt, v.access AS view_audit FROM #scoped# p
JOIN %role_permissions% s ON s.role = p.user_role AND s.capability = 'submit_prompt' JOIN %role_permissions% v ON v.role = p.user_role AND v.capability = 'view_audit'""")
def capability_check(inp: Inputs):
    caps = ["submit_prompt", "view_audit"]
    return access.with_grants(inp.view("scoped"), inp.dim("role_permissions"), "user_role", caps).select("request_id", "user_role", *caps)


@query("dataset_scope", """SELECT request_id, dataset FROM #scoped# WHERE user_role = 'ANALYST' AND NOT list_contains(string_split(approved_datasets, ','), dataset)""")
def dataset_scope(inp: Inputs):
    outside = access.outside_datasets(F.col("user_role"), F.col("dataset"), access.listed(F.col("approved_datasets")))
    return inp.view("scoped").where(outside).select("request_id", "dataset")


@query("tool_scope", """SELECT request_id, user_role, string_agg(t, ',' ORDER BY t) AS outside FROM (
  SELECT request_id, user_role, approved_tools, unnest(string_split(tool_calls, ',')) AS t FROM #scoped#) x
WHERE t <> '' AND (user_role = 'ANALYST' OR NOT list_contains(string_split(approved_tools, ','), t)) GROUP BY request_id, user_role""")
def tool_scope(inp: Inputs):
    outside = access.outside_tools(F.col("user_role"), access.listed(F.col("tool_calls")), access.listed(F.col("approved_tools")))
    return inp.view("scoped").withColumn("o", outside).where(F.size("o") > 0).select(
        "request_id", "user_role", F.array_join(F.array_sort("o"), ",").alias("outside")
    )


@query("tool_set_difference", """SELECT session_id, unnest(string_split(tool_calls, ',')) AS tool FROM #scoped# WHERE tool_calls <> ''
EXCEPT SELECT session_id, unnest(string_split(approved_tools, ',')) FROM #scoped# b WHERE approved_tools <> '' AND user_role = 'DEVELOPER'""")
def tool_set_difference(inp: Inputs):
    s = inp.view("scoped")
    asked = s.select("session_id", F.explode(access.listed(F.col("tool_calls"))).alias("tool"))
    approved = s.where("user_role = 'DEVELOPER'").select("session_id", F.explode(access.listed(F.col("approved_tools"))).alias("tool"))
    return asked.subtract(approved)


@query("role_template_join", "SELECT p.request_id, t.role AS user_role, t.template FROM #scoped# p JOIN %role_templates% t ON t.role = p.user_role")
def role_template_join(inp: Inputs):
    return access.with_template(inp.view("scoped"), inp.dim("role_templates"), "user_role").select("request_id", "user_role", "template")


@query("render_system_prompt", """SELECT p.request_id, replace(replace(t.template, '{approved_datasets}', CASE WHEN approved_datasets = '' THEN '(none)' ELSE replace(approved_datasets, ',', ', ') END),
  '{approved_tools}', CASE WHEN approved_tools = '' THEN '(none)' ELSE replace(approved_tools, ',', ', ') END) AS system_prompt
FROM #scoped# p JOIN %role_templates% t ON t.role = p.user_role""")
def render_system_prompt(inp: Inputs):
    j = access.with_template(inp.view("scoped"), inp.dim("role_templates"), "user_role")
    prompt = access.render_prompt(F.col("template"), access.listed(F.col("approved_datasets")), access.listed(F.col("approved_tools")))
    return j.select("request_id", prompt.alias("system_prompt"))


@query("role_hierarchy", """WITH RECURSIVE below(ancestor, role) AS (
  SELECT DISTINCT r, r FROM (SELECT parent AS r FROM %role_edges% UNION SELECT child AS r FROM %role_edges%) x
  UNION ALL SELECT b.ancestor, e.child FROM below b JOIN %role_edges% e ON e.parent = b.role)
SELECT ancestor, count(DISTINCT b.role) AS n_roles, CAST(count(p.user_role) AS BIGINT) AS requests FROM below b LEFT JOIN #scoped# p ON p.user_role = b.role GROUP BY ancestor""")
def role_hierarchy(inp: Inputs):
    counts = inp.view("scoped").groupBy("user_role").agg(F.count("*").alias("requests"))
    return access.role_rollup(counts, "user_role", "requests")
