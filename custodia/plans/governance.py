"""Alert feed, rollback decisions and the compliance report."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.functions import threats
from custodia.functions import text as tx
from custodia.operators import agents, governance, latency, quality, tokens
from custodia.plans import audit as audit_plan
from custodia.plans import evaluation, pii, tokens as token_plan
from custodia.plans.registry import Inputs, fragment, query

fragment("alerts", """SELECT a.alert, r.severity, r.channel, r.response, a.key, round(CAST(a.value AS DOUBLE), 6) AS value FROM (
  SELECT 'role_escalation_attempt' AS alert, CAST(doc_id AS VARCHAR) AS key, 1e0 AS value FROM #q_role_escalation_flag# a
  UNION ALL SELECT 'pii_token_not_found', CAST(request_id AS VARCHAR), len(unresolved) FROM #detokenized# b WHERE len(unresolved) > 0
  UNION ALL SELECT 'anomalous_token_volume', concat(user_id, '@', hour), tokens FROM #q_token_volume_anomaly# c
  UNION ALL SELECT 'tool_outside_registry', CAST(call_id AS VARCHAR), 1 FROM #q_unregistered_tool_calls# d
  UNION ALL SELECT 'hallucination_spike', window_start, rate FROM #q_hallucination_spike_1h# e
  UNION ALL SELECT 'latency_regression', concat(model_id, '@', day), p95 FROM #q_ttft_regression# f
  UNION ALL SELECT 'grounding_drop', concat(model_id, '@', day), "drop" FROM #q_grounding_drop_dod# g
  UNION ALL SELECT 'low_self_consistency', concat(model_id, '@', started), run_length FROM #q_low_consistency_runs# h
  UNION ALL SELECT 'eval_run_failure', model_id, count(*) FROM #evaluated# i WHERE NOT passed GROUP BY model_id) a JOIN %alert_rules% r ON r.alert = a.alert""")


def _at(df, ts: str):
    return F.concat_ws("@", "model_id", F.col(ts).cast("string"))


def _attacks(inp):
    hit = pii.attacked(inp).where(threats.escalation_attempt(F.col("text")))
    return hit, F.col("doc_id"), F.lit(1)


def _unresolved(inp):
    return token_plan.unresolved(inp), F.col("request_id"), F.col("n")


def _volume(inp):
    over = latency.volume_anomalies(latency.hourly_volume(inp.view("traces")))
    return over, F.concat_ws("@", "user_id", F.col("hour").cast("string")), F.col("tokens")


def _unknown_tools(inp):
    return agents.unregistered_calls(inp.view("tool_calls"), inp.dim("tool_registry")), F.col("call_id"), F.lit(1)


def _spikes(inp):
    rate = quality.rate_by_window(inp.view("traces"), [], "1 hour", evaluation.bad())
    return rate.where("rate > 0.05"), F.col("window_start"), F.col("rate")


def _slow(inp):
    days = latency.ttft_regressions(inp.view("traces"))
    return days, _at(days, "day"), F.col("p95")


def _drops(inp):
    days = quality.drop_day_over_day(inp.view("traces"), ["model_id"], "grounding_score")
    return days, _at(days, "day"), F.col("drop")


def _runs(inp):
    runs = quality.low_runs(inp.view("traces"), "model_id", "self_consistency_score", ["ts", "request_id"])
    return runs, _at(runs, "started"), F.col("run_length")


def _failed_evals(inp):
    failed = evaluation.evaluated(inp).where(~F.col("passed")).groupBy("model_id").agg(F.count("*").alias("n"))
    return failed, F.col("model_id"), F.col("n")


RULES = {
    "role_escalation_attempt": _attacks, "pii_token_not_found": _unresolved, "anomalous_token_volume": _volume,
    "tool_outside_registry": _unknown_tools, "hallucination_spike": _spikes, "latency_regression": _slow,
    "grounding_drop": _drops, "low_self_consistency": _runs, "eval_run_failure": _failed_evals,
}


def feed(inp: Inputs, names: list[str] | None = None):
    """Alert feed of the named rules, all by default."""
    parts = []
    for name in names or RULES:
        hits, key, value = RULES[name](inp)
        parts.append(governance.alert_rows(hits, name, key, value))
    return governance.alert_feed(parts, inp.dim("alert_rules"))


@query("alert_union", "SELECT alert, severity, channel, key, value FROM #alerts# a")
def alert_union(inp: Inputs):
    return feed(inp).select("alert", "severity", "channel", "key", "value")


@query("severity_route", "SELECT severity, channel, alert, count(*) AS n FROM #alerts# a GROUP BY 1, 2, 3")
def severity_route(inp: Inputs):
    return governance.route(feed(inp))


@query("rollback_decision", """SELECT model_id, max_by(m.severity, severity_rank) AS severity, max_by(approver, severity_rank) AS approver, max_by(target_minutes, severity_rank) AS target_minutes, count(*) AS alerts,
  max(severity_rank) >= 3 AS rollback FROM (SELECT split_part(key, '@', 1) AS model_id, severity FROM #alerts# a WHERE alert IN ('latency_regression', 'grounding_drop', 'low_self_consistency', 'eval_run_failure')) x
JOIN %rollback_matrix% m ON m.severity = x.severity GROUP BY model_id""")
def rollback_decision(inp: Inputs):
    by_model = feed(inp, ["latency_regression", "grounding_drop", "low_self_consistency", "eval_run_failure"])
    by_model = by_model.withColumn("model_id", F.split_part("key", F.lit("@"), F.lit(1)))
    return governance.rollback_decision(by_model, inp.dim("rollback_matrix"), "model_id")


@query("version_rank", """SELECT model_id, version, CAST(row_number() OVER (PARTITION BY model_id ORDER BY deployed DESC) AS INTEGER) AS rank, lead(version) OVER (PARTITION BY model_id ORDER BY deployed DESC) AS previous,
  max(eval_score) OVER (PARTITION BY model_id ORDER BY deployed) AS best_so_far FROM #versions# v""")
def version_rank(inp: Inputs):
    return governance.version_rank(inp.view("versions")).select("model_id", "version", "rank", "previous", "best_so_far")


@query("rollback_target", """SELECT c.model_id, c.version AS current_version, t.version AS target_version, t.eval_score AS target_score
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY deployed DESC) AS rn FROM #versions# v) a WHERE rn = 1) c
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY deployed DESC) AS rn FROM (
  SELECT *, max(deployed) OVER (PARTITION BY model_id) AS newest FROM #versions# w) b0 WHERE eval_score >= 0.922 AND deployed < newest) b WHERE rn = 1) t USING (model_id)""")
def rollback_target(inp: Inputs):
    return governance.rollback_target(inp.view("versions"), 0.922)


# --- controls ----------------------------------------------------------------
fragment("control_rows", """SELECT c.ord, c.control_id, c.description, CASE WHEN x.ok THEN 'PASS' WHEN f.failed THEN 'FAIL' ELSE 'SKIPPED' END AS status
FROM %controls% c LEFT JOIN (SELECT control_id, bool_or(passed) AS ok FROM #check_results# r GROUP BY 1) x USING (control_id), (SELECT bool_or(NOT passed) AS failed FROM #check_results# s) f""")
_NOTE = "coalesce('Failing controls: ' || string_agg(CASE WHEN status <> 'PASS' THEN control_id END, ', ' ORDER BY ord), '')"
_OVERALL = "CASE WHEN bool_and(status = 'PASS') THEN 'APPROVED' ELSE 'REVIEW_REQUIRED' END"


def control_rows(inp: Inputs):
    return governance.control_status(inp.view("check_results"), inp.dim("controls"))


@query("control_status", "SELECT ord, control_id, description, status FROM #control_rows# c")
def control_status(inp: Inputs):
    return control_rows(inp)


@query("control_overall", f"SELECT count(*) AS controls, count(*) FILTER (status = 'PASS') AS passed, {_OVERALL} AS overall_status FROM #control_rows# c")
def control_overall(inp: Inputs):
    return governance.overall(control_rows(inp)).drop("note")


@query("failing_controls_note", f"SELECT {_NOTE} AS note FROM #control_rows# c")
def failing_controls_note(inp: Inputs):
    return governance.overall(control_rows(inp)).select("note")


@query("report_json_sink", f"""SELECT CAST(to_json({{'generated_at': '2024-01-31T00:00:00+00:00', 'prd_version': '1.0', 'overall_status': o, 'controls': cs, 'audit_record_count': (SELECT count(*) FROM #log# l), 'notes': CASE WHEN note = '' THEN [] ELSE [note] END}}) AS VARCHAR) AS report
FROM (SELECT {_OVERALL} AS o, {_NOTE} AS note, list({{'control_id': control_id, 'description': description, 'status': status, 'evidence': evidence}} ORDER BY ord) AS cs FROM (
  SELECT c.*, concat('checks: ', CAST(coalesce(p, 0) AS VARCHAR), ' passed, ', CAST(coalesce(f, 0) AS VARCHAR), ' failed') AS evidence FROM #control_rows# c LEFT JOIN (
    SELECT control_id, count(*) FILTER (passed) AS p, count(*) FILTER (NOT passed) AS f FROM #check_results# r GROUP BY 1) n USING (control_id)) e) x""")
def report_json_sink(inp: Inputs):
    rows = governance.check_evidence(inp.view("check_results"), control_rows(inp))
    return governance.report_json(rows, audit_plan.log(inp), "2024-01-31T00:00:00+00:00")


fragment("run_words", """SELECT run_id, bool_or(contains(lower(line), 'passed')) AS p, bool_or(contains(lower(line), 'prompt_injection')) AS g1, bool_or(contains(lower(line), 'pii_redact') OR contains(lower(line), 'pii_in_injection') OR contains(lower(line), 'pii_in_retrieved')) AS g2,
  bool_or(contains(lower(line), 'audit')) AS g3, bool_or(contains(lower(line), 'latency')) AS g4, bool_or(contains(lower(line), 'indirect_injection')) AS rt1, bool_or(contains(lower(line), 'token_smuggling') OR contains(lower(line), 'fake_token')) AS rt2 FROM #run_output# o GROUP BY run_id""")


@query("keyword_all_match", """SELECT run_id, line_no FROM #run_output# o WHERE contains(lower(line), 'token') AND contains(lower(line), 'passed') AND contains(lower(line), 'red_team')""")
def keyword_all_match(inp: Inputs):
    wanted = F.array(*[F.lit(w) for w in ("Token", "PASSED", "red_team")])
    return inp.view("run_output").where(tx.all_keywords(F.col("line"), wanted)).select("run_id", "line_no")


@query("control_evidence", """SELECT run_id, control_id, CASE WHEN p AND CASE control_id WHEN 'G1' THEN g1 WHEN 'G2' THEN g2 WHEN 'G3' THEN g3 WHEN 'G4' THEN g4 WHEN 'RT1' THEN rt1 ELSE rt2 END THEN 'PASS' WHEN exit_code <> 0 THEN 'FAIL' ELSE 'SKIPPED' END AS status,
  concat('pytest tests/validation/ (exit=', CAST(exit_code AS VARCHAR), ')') AS evidence FROM #validation_runs# v JOIN #run_words# w USING (run_id), (SELECT unnest(['G1', 'G2', 'G3', 'G4', 'RT1', 'RT2']) AS control_id) c""")
def control_evidence(inp: Inputs):
    checks = governance.evidence_checks(inp.view("run_output"), inp.dim("control_keywords"))
    return governance.run_controls(inp.view("validation_runs"), checks, inp.dim("controls")).select("run_id", "control_id", "status", "evidence")
