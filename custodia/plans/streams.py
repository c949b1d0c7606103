"""Streaming jobs run to completion over the test tables.

A window is emitted once the watermark passes its end, so the equivalent SQL
keeps windows that end at least ten minutes before the newest row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.plans import evaluation
from custodia.plans.registry import Inputs, query
from custodia.streaming import jobs, sinks

_CLOSED = "(SELECT max({0}) - INTERVAL '10' MINUTE FROM {1})"


def text(c, name=None):
    return F.col(c).cast("string").alias(name or c)


@query("stream_redact", "SELECT request_id, redacted, CAST(n AS INTEGER) AS pii_token_count FROM #redacted# r")
def stream_redact(inp: Inputs):
    out = jobs.redact(inp.stream_view("prompts"), "prompt", "request_id")
    return sinks.run_available(out.select("request_id", "redacted", F.size("entities").alias("pii_token_count")), "redact")


@query("stream_audit_append", "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, latency_ms FROM #log# l")
def stream_audit_append(inp: Inputs):
    base = sinks.fresh_dir(inp.spark, "audit")
    records = inp.stream_view("audit_input")
    sinks.run_batches(records, base, sinks.append_audit(base, ["ts", "record_no"]))
    return inp.spark.read.parquet(f"{base}/log").select("event_id", text("ts"), "user_id", "latency_ms")


@query("stream_token_ttl", "SELECT DISTINCT token, type, session_id FROM #token_map# m")
def stream_token_ttl(inp: Inputs):
    base = sinks.fresh_dir(inp.spark, "tokens")
    puts = jobs.prompt_tokens(inp.stream_view("prompts"), "prompt", "request_id")
    sinks.run_batches(puts, base, sinks.append_token_map(base))
    return inp.spark.read.parquet(f"{base}/map").select("token", "type", "session_id")


@query("stream_hallucination_1h", f"""SELECT CAST(w AS VARCHAR) AS window_start, count(*) AS n, round(avg(b), 6) AS rate FROM (
  SELECT time_bucket(INTERVAL 15 MINUTES, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 15 MINUTES AS w, {evaluation.BAD} AS b FROM #traces# t, unnest([0, 1, 2, 3]) u(i)) x
WHERE w + INTERVAL 1 HOUR <= {_CLOSED.format('ts', 'events')} GROUP BY w HAVING avg(b) > 0.05""")
def stream_hallucination_1h(inp: Inputs):
    out = sinks.run_available(jobs.hallucination_alerts(inp.stream_view("traces")), "hallucination")
    return out.select(text("window_start"), "n", F.round("rate", 6).alias("rate"))


@query("stream_latency_p95", f"""SELECT model_id, CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, count(*) AS n, quantile_disc(total_latency_ms, 0.95) AS p95 FROM #traces# t
GROUP BY model_id, date_trunc('hour', ts) HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED.format('ts', 'events')}""")
def stream_latency_p95(inp: Inputs):
    out = sinks.run_available(jobs.latency_p95(inp.stream_view("traces"), "total_latency_ms"), "p95")
    return out.select("model_id", text("window_start"), "n", "p95")


def run_ordered(inp: Inputs, step: sinks.Ordered, stream):
    """Run an ordered job over the whole stream and end it."""
    sinks.run_batches(stream, step.base, step)
    step.finish(inp.spark)
    return step


@query("stream_low_consistency", "SELECT model_id, started, run_length FROM #q_low_consistency_runs# r")
def stream_low_consistency(inp: Inputs):
    step = sinks.LowRuns(sinks.fresh_dir(inp.spark, "low-runs"), "model_id", "self_consistency_score", [("ts", "timestamp"), ("request_id", "bigint")])
    return run_ordered(inp, step, inp.stream_view("traces")).runs(inp.spark).select("model_id", text("started"), "run_length")


@query("stream_message_ttl", """SELECT trace_id, seq FROM #messages# m WHERE NOT EXISTS (SELECT 1 FROM #messages# r WHERE r.trace_id = m.trace_id AND r.seq = m.seq + 1 AND r.created_at BETWEEN m.created_at AND m.created_at + INTERVAL '300' SECOND)
AND created_at + INTERVAL '300' SECOND < (SELECT max(created_at) - INTERVAL '10' MINUTE FROM #messages# z)""")
def stream_message_ttl(inp: Inputs):
    step = sinks.MessageTtl(sinks.fresh_dir(inp.spark, "ttl"))
    sinks.run_batches(inp.stream_view("messages"), step.base, step)  # not ended: what is open may still be answered
    return step.alerts(inp.spark).select("trace_id", "seq")


@query("stream_rate_limit", "SELECT agent, tool, ts, n_trailing, allowed FROM #q_tool_rate_limit# r")
def stream_rate_limit(inp: Inputs):
    step = sinks.RateLimit(sinks.fresh_dir(inp.spark, "rate"), inp.dim("tool_registry"))
    return run_ordered(inp, step, inp.stream_view("tool_calls")).alerts(inp.spark).select("agent", "tool", text("ts"), "n_trailing", "allowed")


@query("stream_sessions", f"""SELECT user_id, CAST(min(ts) AS VARCHAR) AS started, CAST(max(ts) + INTERVAL 1 HOUR AS VARCHAR) AS ended, count(*) AS n FROM (
  SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (
    SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM #traces# t) a) b
GROUP BY user_id, s HAVING max(ts) + INTERVAL 1 HOUR <= {_CLOSED.format('ts', 'events')}""")
def stream_sessions(inp: Inputs):
    out = sinks.run_available(jobs.sessions(inp.stream_view("traces").select("user_id", "ts"), "user_id", "ts"), "sessions")
    return out.select("user_id", text("started"), text("ended"), "n")


@query("stream_weekly_status", f"""SELECT CAST(as_of AS VARCHAR) AS as_of, project, status, count(*) AS n FROM (
  SELECT *, time_bucket(INTERVAL 7 DAYS, updated_at, TIMESTAMP '1970-01-05 08:00:00') + INTERVAL 7 DAYS AS as_of FROM #issues# i) x
WHERE as_of <= {_CLOSED.format('o_orderdate', 'orders')} GROUP BY 1, 2, 3""")
def stream_weekly_status(inp: Inputs):
    out = sinks.run_available(jobs.weekly_status(inp.stream_view("issues")), "weekly")
    return out.select(text("as_of"), "project", "status", "n")
