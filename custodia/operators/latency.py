"""Latency percentiles, service level checks and load shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.operators.percentiles import exact_percentiles, ranked
from custodia.sources import dims


def metric_percentiles(
    traces: DataFrame, keys: list[str], wanted: dict[str, dict[str, float]], how: str = "linear", **options
) -> DataFrame:
    """Percentiles of several columns per key, from one pass over a long form.

    ``wanted`` maps a column to {result name: probability}.
    """
    long = traces.select(
        *keys, F.inline(F.array(*[F.struct(F.lit(m).alias("__m"), F.col(m).cast("double").alias("__x")) for m in wanted]))
    )
    probs = {f"p{round(p * 1e6)}": p for ps in wanted.values() for p in ps.values()}
    per = exact_percentiles(long, [*keys, "__m"], "__x", probs, how, **options)
    cols = [
        F.max(F.when(F.col("__m") == m, F.col(f"p{round(p * 1e6)}"))).alias(name)
        for m, ps in wanted.items() for name, p in ps.items()
    ]
    return per.groupBy(*keys).agg(F.max("n").alias("n"), *cols)


def summary(traces: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Mean, median and the element at ``int(n * 0.99)`` of the sorted values."""
    return ranked(traces, keys or [], value, {"median": (0.5, "linear"), "p99": (0.99, "index")})


def with_slo(traces: DataFrame, slos: DataFrame, task: str = "task_type") -> DataFrame:
    """Attach the latency bounds of the task, or the default ones."""
    default = next(r for r in dims.DIMS["latency_slos"].rows if r[0] == "default")
    bounds = slos.select(F.col("task_type").alias("__task"), F.col("ttft_p95_ms").alias("__a"), F.col("total_p95_ms").alias("__b"))
    name = F.when(F.col(task) == "rag", "rag_query").otherwise(F.col(task))  # both spellings are in use
    return traces.join(bounds, name == F.col("__task"), "left").select(
        *traces.columns, F.coalesce("__a", F.lit(default[1])).alias("ttft_slo_ms"), F.coalesce("__b", F.lit(default[2])).alias("total_slo_ms")
    )


def tokens_per_second(completion: Column, total_ms: Column, ttft_ms: Column) -> Column:
    return completion * 1000 / F.nullif(total_ms - ttft_ms, F.lit(0.0))


def hourly_volume(traces: DataFrame, user: str = "user_id", ts: str = "ts") -> DataFrame:
    return traces.groupBy(user, F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(
        F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens")
    )


def volume_anomalies(hourly: DataFrame, ratio: float = dims.TOKEN_VOLUME_RATIO, trailing: int = 24, user: str = "user_id") -> DataFrame:
    """Hours above ``ratio`` times the mean of the user's preceding active hours.

    The window runs over hourly cells, so its size follows the time span, not the traffic.
    """
    w = W.partitionBy(user).orderBy("hour").rowsBetween(-trailing, -1)
    with_base = hourly.withColumn("baseline", F.avg("tokens").over(w))
    return with_base.where(F.col("tokens") > ratio * F.col("baseline"))


def ttft_regressions(traces: DataFrame, ratio: float = dims.TTFT_REGRESSION_RATIO) -> DataFrame:
    """Days whose P95 time to first token exceeds ``ratio`` times the mean of the 7 days before."""
    daily = exact_percentiles(
        traces.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz")), ["model_id", "day"], "ttft_ms", {"p95": 0.95}
    ).drop("n")
    return daily.sparkSession.sql(f"""
        SELECT * FROM (SELECT *, avg(p95) OVER (PARTITION BY model_id ORDER BY day
          RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS baseline FROM {{daily}})
        WHERE p95 > {float(ratio)} * baseline""", daily=daily)


def sustained_load(requests: DataFrame, width: str, per_window: int, windows: int, ts: str = "ts") -> DataFrame:
    """Windows that end a stretch of ``windows`` consecutive ones with at least ``per_window`` requests.

    Every good window votes for itself and its successors; no ordering is needed.
    """
    counts = requests.groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("n")).where(F.col("n") >= per_window)
    spread = counts.select("w", "n", F.explode(F.sequence(F.lit(0), F.lit(windows - 1))).alias("i"))
    votes = spread.select((F.col("w.start") + F.col("i") * (F.col("w.end") - F.col("w.start"))).alias("window_start"), "n")
    return votes.groupBy("window_start").agg(F.count("*").alias("k"), F.min("n").alias("min_n")).where(F.col("k") == windows).drop("k")
