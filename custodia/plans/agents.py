"""Agent messages, tool calls, context and escalation."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.functions.threats import sensitive_text
from custodia.operators import agents, search
from custodia.operators.percentiles import exact_percentiles
from custodia.streaming.sinks import fresh_dir
from custodia.plans.registry import Inputs, fragment, query
from custodia.operators import governance
from custodia.sources import dims

SECTIONS = ["jira", "notion", "slack", "calendar"]
LAST_ISSUE = "2001-08-01 00:00:00"
AS_OF = "2024-01-31 00:00:00"


def messages(inp: Inputs):
    return inp.view("messages")


def calls(inp: Inputs):
    return inp.view("tool_calls")


def r6(c, name):
    return F.round(c, 6).alias(name)


# --- permissions -------------------------------------------------------------
@query("message_permission_violations", """SELECT trace_id, seq, sender, recipient, message_type FROM #messages# m
WHERE NOT EXISTS (SELECT 1 FROM %message_permissions% p WHERE p.sender = m.sender AND p.recipient = m.recipient AND p.message_type = m.message_type)""")
def message_permission_violations(inp: Inputs):
    return agents.forbidden_messages(messages(inp), inp.dim("message_permissions")).select("trace_id", "seq", "sender", "recipient", "message_type")


@query("unregistered_tool_calls", "SELECT call_id, trace_id, tool FROM #tool_calls# c WHERE tool NOT IN (SELECT tool FROM %tool_registry%)")
def unregistered_tool_calls(inp: Inputs):
    return agents.unregistered_calls(calls(inp), inp.dim("tool_registry")).select("call_id", "trace_id", "tool")


@query("tool_registry_filter", "SELECT call_id, tool, r.tool IS NOT NULL AS registered FROM #tool_calls# c LEFT JOIN %tool_registry% r USING (tool)")
def tool_registry_filter(inp: Inputs):
    names = F.broadcast(inp.dim("tool_registry").select("tool", F.lit(True).alias("known")))
    return calls(inp).join(names, "tool", "left").select("call_id", "tool", F.coalesce("known", F.lit(False)).alias("registered"))


@query("unauthorized_agent_tools", """SELECT call_id, agent, c.tool FROM #tool_calls# c JOIN %tool_registry% r ON r.tool = c.tool WHERE NOT list_contains(r.allowed_agents, c.agent)""")
def unauthorized_agent_tools(inp: Inputs):
    return agents.unauthorized_calls(calls(inp), inp.dim("tool_registry")).select("call_id", "agent", "tool")


@query("trust_level_violation", """SELECT 'message' AS kind, concat(trace_id, ':', seq) AS item, sender AS agent FROM #messages# m LEFT JOIN %agent_trust% t ON t.agent = m.sender
WHERE coalesce(level, 1) = 1 AND NOT (message_type = 'route' AND recipient = 'ORCHESTRATOR')
UNION ALL SELECT 'tool', CAST(call_id AS VARCHAR), c.agent FROM #tool_calls# c LEFT JOIN %agent_trust% t ON t.agent = c.agent WHERE NOT coalesce(can_write, FALSE) AND tool NOT LIKE '%\\_search' ESCAPE '\\'""")
def trust_level_violation(inp: Inputs):
    return agents.trust_violations(messages(inp), calls(inp), inp.dim("agent_trust"))


@query("trust_immutability", """SELECT agent, count(DISTINCT level) AS n_levels FROM (SELECT c.agent, CASE WHEN tool = 'jira_delete' AND status = 'failed' THEN level + 1 ELSE level END AS level
  FROM #tool_calls# c JOIN %agent_trust% t ON t.agent = c.agent) x GROUP BY agent HAVING count(DISTINCT level) > 1""")
def trust_immutability(inp: Inputs):
    raised = F.when((F.col("tool") == "jira_delete") & (F.col("status") == "failed"), F.col("level") + 1).otherwise(F.col("level"))
    return agents.trust_changes(calls(inp).join(inp.dim("agent_trust"), "agent").select("agent", raised.alias("level")))


@query("required_params_check", """SELECT call_id, tool, array_to_string(list_sort(missing), ',') AS missing FROM (SELECT call_id, c.tool, list_filter(r.required_params, lambda x: NOT list_contains(json_keys(c.params), x)) AS missing
  FROM #tool_params# c JOIN %tool_registry% r ON r.tool = c.tool) x WHERE len(missing) > 0""")
def required_params_check(inp: Inputs):
    m = agents.missing_params(inp.view("tool_params"), inp.dim("tool_registry"), "params")
    return m.select("call_id", "tool", F.array_join(F.array_sort("missing"), ",").alias("missing"))


@query("approval_flag_check", """SELECT call_id, c.tool FROM #tool_params# c JOIN %tool_registry% r ON r.tool = c.tool WHERE list_contains(r.allowed_agents, 'EXECUTION') AND NOT coalesce(orchestrator_approval, FALSE)""")
def approval_flag_check(inp: Inputs):
    return agents.unapproved(inp.view("tool_params"), inp.dim("tool_registry"), "orchestrator_approval").select("call_id", "tool")


# only a JSON true counts: not its absence, a text, a note about it or text that is no JSON
@query("payload_approval", """SELECT call_id, c.tool FROM #tool_params# c JOIN %tool_registry% r ON r.tool = c.tool WHERE list_contains(r.allowed_agents, 'EXECUTION')
  AND CAST(regexp_extract(CAST((SELECT props FROM events e WHERE e.event_id = c.call_id) AS VARCHAR), '([0-9]+)', 1) AS INT) % 8 < 5""")
def payload_approval(inp: Inputs):
    return agents.unapproved(inp.view("tool_params"), inp.dim("tool_registry"), agents.approval(F.col("payload"))).select("call_id", "tool")


@query("tool_rate_limit", """SELECT agent, x.tool, CAST(ts AS VARCHAR) AS ts, n_trailing, CAST(split_part(r.rate_limit, '/', 1) AS INTEGER) AS allowed FROM (
  SELECT DISTINCT agent, tool, ts, count(*) OVER (PARTITION BY agent, tool ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n_trailing FROM #tool_calls# c) x
JOIN %tool_registry% r ON r.tool = x.tool WHERE n_trailing > CAST(split_part(r.rate_limit, '/', 1) AS INTEGER)""")
def tool_rate_limit(inp: Inputs):
    over = agents.over_rate_limit(calls(inp), inp.dim("tool_registry"))
    return over.select("agent", "tool", F.col("ts").cast("string").alias("ts"), "n_trailing", "allowed")


# --- chains ------------------------------------------------------------------
@query("consecutive_failures", """SELECT trace_id, call_id FROM (SELECT trace_id, call_id, status, lag(status) OVER (PARTITION BY trace_id ORDER BY ts, call_id) AS prev FROM #tool_calls# c) x WHERE status = 'failed' AND prev = 'failed'""")
def consecutive_failures(inp: Inputs):
    return agents.consecutive_failures(calls(inp)).select("trace_id", "call_id")


@query("message_ttl_expired", """SELECT trace_id, seq, coalesce(next_at <= TIMESTAMP '2024-01-03 00:00:00', FALSE) AS answered_late FROM (SELECT *, lead(created_at) OVER (PARTITION BY trace_id ORDER BY seq) AS next_at FROM #messages# m) x
WHERE coalesce(next_at > created_at + INTERVAL '300' SECOND, TRUE) AND created_at + INTERVAL '300' SECOND < TIMESTAMP '2024-01-03 00:00:00'""")
def message_ttl_expired(inp: Inputs):
    as_of = F.expr("TIMESTAMP '2024-01-03 00:00:00'")
    return agents.expired(messages(inp), as_of).select("trace_id", "seq", "answered_late")


@query("approval_chain_check", """SELECT trace_id, seq FROM #messages# m WHERE recipient = 'EXECUTION' AND NOT EXISTS (
  SELECT 1 FROM #messages# p WHERE p.trace_id = m.trace_id AND p.seq <= m.seq AND p.sender = 'ORCHESTRATOR' AND p.recipient = 'EXECUTION' AND p.message_type = 'execute')""")
def approval_chain_check(inp: Inputs):
    return agents.unapproved_actions(messages(inp), F.col("recipient") == "EXECUTION")


@query("escalation_reentry", """SELECT m.trace_id, m.seq, count(p.seq) AS attempts FROM #messages# m LEFT JOIN #messages# p ON p.trace_id = m.trace_id AND p.seq <= m.seq AND p.message_type = 'human_response' GROUP BY 1, 2""")
def escalation_reentry(inp: Inputs):
    return agents.reentries(messages(inp)).select("trace_id", "seq", "attempts")


@query("trace_assembly", """SELECT m.trace_id, m.seq, count(*) AS position, max(CASE WHEN p.sender = 'INTAKE' THEN p.seq END) AS intake_seq,
  max_by(CASE WHEN p.sender = 'ORCHESTRATOR' THEN p.message_type END, CASE WHEN p.sender = 'ORCHESTRATOR' THEN p.seq END) AS last_order FROM #messages# m JOIN #messages# p ON p.trace_id = m.trace_id AND p.seq <= m.seq GROUP BY 1, 2""")
def trace_assembly(inp: Inputs):
    context = {
        "intake_seq": F.when(F.col("sender") == "INTAKE", F.col("seq")),
        "last_order": F.when(F.col("sender") == "ORCHESTRATOR", F.col("message_type")),
    }
    return agents.assemble(messages(inp).select("trace_id", "seq", "sender", "message_type"), context).select("trace_id", "seq", "position", "intake_seq", "last_order")


@query("trace_duration", "SELECT trace_id, count(*) AS messages, CAST(epoch(max(created_at)) - epoch(min(created_at)) AS DOUBLE) AS seconds FROM #messages# m GROUP BY trace_id")
def trace_duration(inp: Inputs):
    return agents.durations(messages(inp)).select("trace_id", "messages", "seconds")


@query("chain_concurrency", """WITH c AS (SELECT user_id, min(ts) AS s, max(ts) AS e FROM events GROUP BY user_id) SELECT max(n) AS peak FROM (SELECT a.s, count(*) AS n FROM c a JOIN c b ON b.s <= a.s AND a.s < b.e GROUP BY a.s, a.user_id) x""")
def chain_concurrency(inp: Inputs):
    chains = inp.table("events").groupBy("user_id").agg(F.min("ts").alias("started"), F.max("ts").alias("ended"))
    return agents.peak_concurrency(chains)


@query("routing_latency", """SELECT count(*) AS n, round(quantile_cont(seconds, 0.5), 6) AS p50, round(quantile_cont(seconds, 0.95), 6) AS p95 FROM (
  SELECT trace_id, epoch(min(CASE WHEN message_type = 'route' THEN created_at END)) - epoch(min(created_at)) AS seconds FROM #messages# m GROUP BY trace_id) x WHERE seconds IS NOT NULL""")
def routing_latency(inp: Inputs):
    p = exact_percentiles(agents.routing_latency(messages(inp)), [], "seconds", {"p50": 0.5, "p95": 0.95})
    return p.select("n", r6("p50", "p50"), r6("p95", "p95"))


# --- requests ----------------------------------------------------------------
_WORDS = "regexp_extract_all(lower(text), '[^\\s.,;:!?]+')"


@query("intent_extract", f"""SELECT trace_id, max_by(intent, (confidence, intent)) AS intent, round(max(confidence), 6) AS confidence FROM (
  SELECT trace_id, intent, len(list_filter(keywords, lambda k: list_contains({_WORDS}, k))) / len(keywords) AS confidence FROM #messages# m, %intent_rules% r WHERE seq = 0) x GROUP BY trace_id""")
def intent_extract(inp: Inputs):
    best = agents.extract_intent(F.col("text"))
    return messages(inp).where("seq = 0").select("trace_id", best.alias("b")).select("trace_id", "b.intent", r6("b.confidence", "confidence"))


@query("intent_confidence_filter", "SELECT trace_id, intent_confidence FROM #messages# m WHERE seq = 0 AND intent_confidence < 0.6")
def intent_confidence_filter(inp: Inputs):
    return messages(inp).where((F.col("seq") == 0) & (F.col("intent_confidence") < dims.INTENT_CONFIDENCE_MIN)).select("trace_id", "intent_confidence")


@query("content_search", f"""SELECT trace_id, seq, CAST(len(list_filter({_WORDS}, lambda w: w IN ('und', 'que', 'the'))) AS INTEGER) AS score FROM #messages# m
WHERE sender = 'INTAKE' AND len(list_filter({_WORDS}, lambda w: w IN ('und', 'que', 'the'))) > 0 ORDER BY score DESC, created_at DESC, trace_id, seq LIMIT 20""")
def content_search(inp: Inputs):
    mine = messages(inp).where("sender = 'INTAKE'")
    order = [F.col("created_at").desc(), F.col("trace_id"), F.col("seq")]
    return agents.search(mine, "text", ["und", "que", "the"], order, 20).select("trace_id", "seq", "score")


@query("content_search_ranked", f"""WITH w AS MATERIALIZED (SELECT trace_id, seq, sender, created_at, {_WORDS} AS ws FROM #messages# m), st AS (SELECT count(*) AS n, avg(len(ws)) AS avgdl FROM w),
t AS MATERIALIZED (SELECT * FROM (SELECT w.*, term, len(list_filter(ws, lambda x: x = term)) AS tf FROM w, (SELECT unnest(['und', 'que', 'the']) AS term) u) x WHERE tf > 0), d AS (SELECT term, count(*) AS df FROM t GROUP BY term)
SELECT trace_id, seq, round(score, 6) AS score FROM (SELECT trace_id, seq, created_at, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / avgdl)) * pow(0.5, (epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(created_at)) / 86400 / 30)) AS score
  FROM t JOIN d USING (term), st WHERE sender = 'INTAKE' AND created_at >= TIMESTAMP '2024-01-01 12:00:00' GROUP BY 1, 2, 3) y ORDER BY y.score DESC, created_at DESC, trace_id, seq LIMIT 25""")
def content_search_ranked(inp: Inputs):
    path = fresh_dir(inp.spark, "search")
    m = messages(inp)
    # two appends, as an index grows
    for half in (0, 1):
        search.append(m.where(F.pmod("trace_id", F.lit(2)) == half), path, ["trace_id", "seq"], "text", "sender", "created_at")
    as_of, since = F.expr("TIMESTAMP '2024-02-01 00:00:00'"), F.expr("TIMESTAMP '2024-01-01 12:00:00'")
    top = search.search(inp.spark, path, ["trace_id", "seq"], ["und", "que", "the"], 25, author="INTAKE", since=since, as_of=as_of, half_life_days=30)
    return top.select("trace_id", "seq", r6("score", "score"))


@query("review_sample", """SELECT trace_id FROM (SELECT trace_id FROM #messages# m GROUP BY trace_id HAVING max(CASE WHEN message_type = 'escalate' THEN 1 ELSE 0 END) = 0) x ORDER BY sha256(CAST(trace_id AS VARCHAR)) LIMIT 10""")
def review_sample(inp: Inputs):
    resolved = messages(inp).groupBy("trace_id").agg(F.max((F.col("message_type") == "escalate").cast("int")).alias("e")).where("e = 0")
    return agents.review_sample(resolved.select("trace_id"), "trace_id", 10)


# --- context -----------------------------------------------------------------
fragment("bundle_items", """SELECT issue_id % 100 AS trace_id, 'jira' AS section, issue_id AS item FROM #issues# i WHERE updated_at >= TIMESTAMP '2001-07-25 00:00:00' AND status = 'O'
UNION ALL SELECT page_id % 100, 'notion', page_id FROM pages WHERE contains(url, '/de/') UNION ALL SELECT trace_id % 100, 'slack', trace_id * 1000 + seq FROM #messages# m WHERE sender = 'ESCALATION'
UNION ALL SELECT event_id % 100, 'calendar', event_id FROM events WHERE event_type = 'purchase' AND value > 150""")
fragment("bundles", """SELECT t.trace_id, count(*) FILTER (section = 'jira') AS n_jira, count(*) FILTER (section = 'notion') AS n_notion, count(*) FILTER (section = 'slack') AS n_slack, count(*) FILTER (section = 'calendar') AS n_calendar, any_value(retrieved_at) AS retrieved_at
FROM (SELECT trace_id, concat(replace(CAST(max(created_at) AS VARCHAR), ' ', 'T'), 'Z') AS retrieved_at FROM #messages# a GROUP BY trace_id) t LEFT JOIN #bundle_items# i USING (trace_id) GROUP BY t.trace_id""")
_GAPS = "concat_ws(',', CASE WHEN n_jira = 0 THEN 'jira' END, CASE WHEN n_notion = 0 THEN 'notion' END, CASE WHEN n_slack = 0 THEN 'slack' END, CASE WHEN n_calendar = 0 THEN 'calendar' END)"
_CONF = "((CASE WHEN n_jira > 0 THEN 1 ELSE 0 END) + (CASE WHEN n_notion > 0 THEN 1 ELSE 0 END) + (CASE WHEN n_slack > 0 THEN 1 ELSE 0 END) + (CASE WHEN n_calendar > 0 THEN 1 ELSE 0 END)) / 4e0"


def bundle_items(inp: Inputs):
    return agents.bundle_items({
        "jira": inp.view("issues").where("updated_at >= TIMESTAMP_NTZ '2001-07-25 00:00:00' AND status = 'O'").select((F.col("issue_id") % 100).alias("trace_id"), F.col("issue_id").alias("item")),
        "notion": inp.table("pages").where(F.contains("url", F.lit("/de/"))).select((F.col("page_id") % 100).alias("trace_id"), F.col("page_id").alias("item")),
        "slack": messages(inp).where("sender = 'ESCALATION'").select((F.col("trace_id") % 100).alias("trace_id"), (F.col("trace_id") * 1000 + F.col("seq")).alias("item")),
        "calendar": inp.table("events").where("event_type = 'purchase' AND value > 150").select((F.col("event_id") % 100).alias("trace_id"), F.col("event_id").alias("item")),
    })


def bundles(inp: Inputs):
    known = messages(inp).groupBy("trace_id").agg(agents.iso_timestamp(F.max("created_at")).alias("retrieved_at"))
    return agents.bundle_headers(known, bundle_items(inp), SECTIONS)


@query("context_bundle", f"SELECT trace_id, n_jira, n_notion, n_slack, n_calendar, {_GAPS} AS gaps, {_CONF} AS confidence, retrieved_at FROM #bundles# b")
def context_bundle(inp: Inputs):
    return bundles(inp).withColumn("gaps", F.array_join("gaps", ","))


@query("context_bundle_lists", """SELECT trace_id, section, part, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items FROM (
  SELECT *, CAST((row_number() OVER (PARTITION BY trace_id, section ORDER BY item) - 1) // 500 AS INTEGER) AS part FROM #bundle_items# i) x GROUP BY 1, 2, 3""")
def context_bundle_lists(inp: Inputs):
    lists = agents.bundle_lists(bundle_items(inp))
    return lists.withColumn("items", F.array_join("items", ","))


@query("context_completeness", f"SELECT trace_id, {_GAPS} AS gaps, {_CONF} AS confidence FROM #bundles# b WHERE {_CONF} < 0.6 OR {_GAPS} <> ''")
def context_completeness(inp: Inputs):
    return agents.incomplete(bundles(inp)).select("trace_id", F.array_join("gaps", ",").alias("gaps"), "confidence")


# --- escalation --------------------------------------------------------------
fragment("packages", """SELECT m.trace_id, m.original_request, coalesce(t.tools, []) AS what_was_attempted, printf('Intent confidence %.2f, %d escalation messages', m.confidence, m.n) AS why_escalating,
  coalesce(o.options, []) AS suggested_actions, b.context_bundle, u.intent AS what_was_understood,
  concat('conv_', m.trace_id) AS requester, CASE WHEN m.confidence < 0.3 THEN 'HIGH' WHEN m.confidence < 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS urgency
FROM (SELECT trace_id, min_by(text, seq) AS original_request, count(*) FILTER (message_type = 'escalate') AS n, min(intent_confidence) AS confidence FROM #messages# a GROUP BY trace_id HAVING count(*) FILTER (message_type = 'escalate') > 0) m
LEFT JOIN (SELECT trace_id, list(tool ORDER BY f, c) AS tools FROM (SELECT trace_id, tool, min(ts) AS f, min_by(call_id, ts) AS c FROM #tool_calls# b WHERE tool IN (SELECT tool FROM %tool_registry%) GROUP BY 1, 2) d GROUP BY trace_id) t USING (trace_id)
LEFT JOIN (SELECT trace_id, {'gaps': list_filter(string_split(""" + _GAPS + """, ','), lambda g: g <> ''), 'confidence': """ + _CONF + """} AS context_bundle FROM #bundles# e) b USING (trace_id)
LEFT JOIN (SELECT trace_id, list(DISTINCT action ORDER BY action) AS options FROM #q_escalation_union# f GROUP BY trace_id) o USING (trace_id)
LEFT JOIN #q_intent_extract# u USING (trace_id)""")


@query("escalation_package", "SELECT trace_id, CAST(to_json({'trace_id': trace_id, 'original_request': original_request, 'what_was_understood': what_was_understood, 'what_was_attempted': what_was_attempted, 'why_escalating': why_escalating, 'suggested_actions': suggested_actions, 'context_bundle': context_bundle, 'requester': requester, 'urgency': urgency}) AS VARCHAR) AS package FROM #packages# p")
def escalation_package(inp: Inputs):
    p = agents.escalation_packages(messages(inp), calls(inp), inp.dim("tool_registry"), bundles(inp), escalation_union(inp))
    return p.select("trace_id", F.to_json(F.struct(*p.columns)).alias("package"))


@query("escalation_union", """SELECT trace_id, trigger, action FROM (
  SELECT DISTINCT trace_id, 'low_intent_confidence' AS trigger FROM #messages# a WHERE seq = 0 AND intent_confidence < 0.6
  UNION ALL SELECT DISTINCT trace_id, 'tool_call_failure' FROM #q_consecutive_failures# b
  UNION ALL SELECT DISTINCT trace_id, 'missing_context' FROM #q_context_completeness# c
  UNION ALL SELECT DISTINCT trace_id, 'ttl_exceeded' FROM #q_trace_duration# d WHERE seconds > 300
  UNION ALL SELECT DISTINCT trace_id, 'sensitive_entity' FROM #messages# e WHERE regexp_matches(lower(text), '\\b(?:""" + "|".join(dims.SENSITIVE_KEYWORDS) + """)\\b')
  UNION ALL SELECT DISTINCT trace_id, 'scope_creep' FROM #q_unregistered_tool_calls# f) x JOIN %escalation_rules% r USING (trigger)""")
def escalation_union(inp: Inputs):
    m, c = messages(inp), calls(inp)
    return governance.escalations({
        "low_intent_confidence": m.where((F.col("seq") == 0) & (F.col("intent_confidence") < dims.INTENT_CONFIDENCE_MIN)),
        "tool_call_failure": agents.consecutive_failures(c),
        "missing_context": agents.incomplete(bundles(inp)),
        "ttl_exceeded": agents.durations(m).where(F.col("seconds") > dims.MESSAGE_TTL_SECONDS),
        "sensitive_entity": m.where(sensitive_text(F.col("text"))),
        "scope_creep": agents.unregistered_calls(c, inp.dim("tool_registry")),
    }, inp.dim("escalation_rules"))


# --- weekly summary and outcome ----------------------------------------------
@query("weekly_status", f"""SELECT project, status, count(*) AS n, count(DISTINCT assignee) AS assignees FROM #issues# i WHERE updated_at BETWEEN TIMESTAMP '{LAST_ISSUE}' - INTERVAL 7 DAYS AND TIMESTAMP '{LAST_ISSUE}' GROUP BY 1, 2""")
def weekly_status(inp: Inputs):
    return agents.weekly_status(inp.view("issues"), LAST_ISSUE)


@query("weekly_sources", f"""SELECT 'issues' AS source, issue_id AS item FROM #issues# i WHERE updated_at >= TIMESTAMP '{LAST_ISSUE}' - INTERVAL 7 DAYS
UNION ALL SELECT 'calendar', event_id FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS
UNION ALL SELECT 'pages', page_id FROM pages WHERE TIMESTAMP '2024-01-20 00:00:00' + page_id * INTERVAL 1 HOUR >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAYS
UNION ALL SELECT 'messages', trace_id FROM #messages# m WHERE created_at >= TIMESTAMP '2024-01-05 00:00:00' - INTERVAL 7 DAYS""")
def weekly_sources(inp: Inputs):
    pages = inp.table("pages").withColumn("modified_at", F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00' + make_dt_interval(0, CAST(page_id AS INT))"))
    return (
        agents.changed_since(inp.view("issues"), "issues", "issue_id", "updated_at", LAST_ISSUE)
        .unionAll(agents.changed_since(inp.table("events"), "calendar", "event_id", "ts", AS_OF))
        .unionAll(agents.changed_since(pages, "pages", "page_id", "modified_at", AS_OF))
        .unionAll(agents.changed_since(messages(inp), "messages", "trace_id", "created_at", "2024-01-05 00:00:00"))
    )


@query("manual_update_share", """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'before' ELSE 'after' END AS phase, count(*) AS n, round(avg(CASE WHEN actor_type = 'human' THEN 1 ELSE 0 END), 6) AS human_share FROM #updates# u GROUP BY 1""")
def manual_update_share(inp: Inputs):
    phase = F.when(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'"), "before").otherwise("after")
    return agents.actor_share(inp.view("updates"), phase).select("phase", "n", r6("human_share", "human_share"))


@query("agent_launch_kpis", """SELECT round(1 - esc, 6) AS completion_rate, round(esc, 6) AS escalation_rate, round(p95, 6) AS e2e_p95, round(1 - (bad + unk) / calls, 6) AS tool_accuracy, bad AS unauthorized, unk AS unregistered, round(sat, 6) AS satisfaction, FALSE AS ready
FROM (SELECT avg(e) AS esc, quantile_cont(seconds, 0.95) AS p95 FROM (SELECT trace_id, max(CASE WHEN message_type = 'escalate' THEN 1 ELSE 0 END) AS e, epoch(max(created_at)) - epoch(min(created_at)) AS seconds FROM #messages# m GROUP BY trace_id) x) a,
  (SELECT count(*) AS calls FROM #tool_calls# c) b, (SELECT count(*) AS bad FROM #q_unauthorized_agent_tools# d) e, (SELECT count(*) AS unk FROM #q_unregistered_tool_calls# f) g,
  (SELECT avg(1 + (CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) + 2) % 5) AS sat FROM events WHERE CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 17 <> 0) h""")
def agent_launch_kpis(inp: Inputs):
    from custodia.operators import quality

    reviews = inp.view("judge").select(quality.parsed_judgement(F.col("judge_json"))["instruction_following"].alias("rating"))
    k = agents.launch_kpis(messages(inp), calls(inp), inp.dim("tool_registry"), reviews, "rating")
    return k.select(
        r6("completion_rate", "completion_rate"), r6("escalation_rate", "escalation_rate"), r6("e2e_p95", "e2e_p95"), r6("tool_accuracy", "tool_accuracy"),
        "unauthorized", "unregistered", r6("satisfaction", "satisfaction"), "ready",
    )
