"""Structured Streaming forms of the jobs. They reuse the batch expressions.

Late rows: every stateful job takes a watermark delay (10 minutes by default).
Rows older than the watermark are dropped and counted by Spark in the query
progress (``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions.text import unnest
from custodia.operators import quality, redaction, tokens
from custodia.sources import dims

DELAY = "10 minutes"


def redact(prompts: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Stateless: the same columns as in batch."""
    return redaction.redact(prompts, text, doc_id)


def windowed_rate(traces: DataFrame, keys: list[str], flag: Column, width: str = "1 hour", slide: str = "15 minutes", ts: str = "ts", delay: str = DELAY) -> DataFrame:
    w = F.window(ts, width, slide)
    agg = traces.withWatermark(ts, delay).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.avg(flag).alias("rate"))
    return agg.select(*keys, F.col("w.start").alias("window_start"), "n", "rate")


def hallucination_alerts(traces: DataFrame, bound: float = dims.HALLUCINATION_RATE_MAX, **options) -> DataFrame:
    flag = quality.hallucinated(F.col("grounding_score"))
    return windowed_rate(traces, [], flag, **options).where(F.col("rate") > bound)


def latency_p95(traces: DataFrame, value: str, width: str = "1 hour", delay: str = DELAY, accuracy: int = 10_000) -> DataFrame:
    """P95 per model and window from a sketch; exact percentiles would keep every value as state."""
    agg = traces.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "model_id").agg(
        F.count("*").alias("n"), F.percentile_approx(value, 0.95, accuracy).alias("p95")
    )
    return agg.select("model_id", F.col("w.start").alias("window_start"), "n", "p95")


def sessions(activity: DataFrame, session: str, ts: str, gap: str = "1 hour", delay: str = DELAY) -> DataFrame:
    s = F.session_window(ts, gap)
    agg = activity.withWatermark(ts, delay).groupBy(s.alias("s"), session).agg(F.count("*").alias("n"))
    return agg.select(session, F.col("s.start").alias("started"), F.col("s.end").alias("ended"), "n")


def weekly_status(issues: DataFrame, ts: str = "updated_at", delay: str = DELAY) -> DataFrame:
    """Seven-day windows that close Mondays at 08:00 (the epoch is a Thursday)."""
    w = F.window(ts, "7 days", "7 days", "4 days 8 hours")
    agg = issues.withWatermark(ts, delay).groupBy(w.alias("w"), "project", "status").agg(F.count("*").alias("n"))
    return agg.select(F.col("w.end").alias("as_of"), "project", "status", "n")


def prompt_tokens(prompts: DataFrame, text: str, doc_id: str, ttl: int = dims.TOKEN_TTL_SECONDS) -> DataFrame:
    """Token puts of arriving prompts, for ``sinks.append_token_map``."""
    found = redaction.detect(prompts, text, doc_id)
    rows = unnest(found, ["session_id", "created_at"], F.col("entities"), "e")
    return tokens.puts_of(rows.select("e.token", "e.value", "e.type", "session_id", "created_at"), "session_id", "created_at", ttl)
