"""Hallucination, consistency, judge and service level metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.operators.ordered import ordered_window
from custodia.sources import dims

JUDGE_SCHEMA = "factual_accuracy INT, completeness INT, hallucination INT, instruction_following INT, notes STRING"
JUDGE_DIMENSIONS = ["factual_accuracy", "completeness", "hallucination", "instruction_following"]


def hallucinated(grounding: Column, bound: float = dims.GROUNDING_SCORE_MIN) -> Column:
    """Only a rate is specified, no formula: a response below the grounding bound counts."""
    return (grounding < bound).cast("int")


def truncated(unit: str, ts: str = "ts") -> Column:
    return F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")


def rate_by_window(traces: DataFrame, keys: list[str], width: str, flag: Column, ts: str = "ts") -> DataFrame:
    """Share of flagged rows per key and tumbling window."""
    return traces.groupBy(*keys, F.window(ts, width).alias("w")).agg(
        F.count("*").alias("n"), F.sum(flag).alias("bad"), F.avg(flag).alias("rate")
    ).select(*keys, F.col("w.start").alias("window_start"), "n", "bad", "rate")


def rolling_rate(traces: DataFrame, keys: list[str], flag: Column, days: int = 7, ts: str = "ts") -> DataFrame:
    """Rate over the trailing days, one point per key and hour.

    Hourly cells are summed first: the ordered window sees hours, not requests.
    """
    cells = traces.groupBy(*keys, truncated("hour", ts).alias("hour")).agg(F.sum(flag).alias("bad"), F.count("*").alias("n"))
    part = ", ".join(keys)
    frame = f"PARTITION BY {part} ORDER BY hour RANGE BETWEEN INTERVAL {int(days)} DAYS PRECEDING AND CURRENT ROW"
    return cells.withColumns(
        {"bad_total": F.expr(f"sum(bad) OVER ({frame})"), "n_total": F.expr(f"sum(n) OVER ({frame})")}
    ).select(*keys, "hour", "bad_total", "n_total", (F.col("bad_total") / F.col("n_total")).alias("rate"))


def drop_day_over_day(traces: DataFrame, keys: list[str], value: str, ratio: float = dims.DROP_RATIO, ts: str = "ts") -> DataFrame:
    """Days whose mean fell by more than ``ratio`` against the calendar day before."""
    daily = traces.groupBy(*keys, truncated("day", ts).alias("day")).agg(F.avg(value).alias("score"))
    w = W.partitionBy(*keys).orderBy("day")
    with_prev = daily.withColumns({"prev_day": F.lag("day").over(w), "prev_score": F.lag("score").over(w)})
    adjacent = F.col("prev_day") + F.expr("INTERVAL 1 DAY") == F.col("day")
    drop = (F.col("prev_score") - F.col("score")) / F.nullif(F.col("prev_score"), F.lit(0.0))
    return with_prev.where(adjacent & (drop > ratio)).select(*keys, "day", "prev_score", "score", drop.alias("drop"))


def low_runs(
    traces: DataFrame, key: str, score: str, order: list[str],
    bound: float = dims.LOW_CONSISTENCY, longer_than: int = dims.LOW_CONSISTENCY_RUN,
) -> DataFrame:
    """Runs of consecutive scores below ``bound``. A row at or above it starts the next island."""
    low = F.coalesce(F.col(score) < bound, F.lit(False))
    marked = ordered_window(
        traces.select(key, *order, score), [key], order,
        running={"__island": ("sum", (~low).cast("bigint"))},
    )
    return marked.where(low).groupBy(key, "__island").agg(
        F.count("*").alias("run_length"), F.min(order[0]).alias("started"), F.max(order[0]).alias("ended"), F.min(score).alias("lowest")
    ).where(F.col("run_length") > longer_than).drop("__island")


def histogram(df: DataFrame, value: str, low: float, high: float, buckets: int) -> DataFrame:
    return df.groupBy(F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))


def parsed_judgement(text: Column) -> Column:
    return F.from_json(text, JUDGE_SCHEMA)


def judge_averages(judged: DataFrame, key: str, text: str) -> DataFrame:
    """Mean of each rubric dimension. An answer that does not parse, lacks a dimension or leaves 1 to 5 is counted, not averaged."""
    parsed = judged.withColumn("__j", parsed_judgement(F.col(text)))
    good = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"__j.{d}").between(1, 5), F.lit(False)) for d in JUDGE_DIMENSIONS])
    return parsed.withColumn("__good", good).groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(~F.col("__good")).alias("malformed"),
        *[F.avg(F.when(F.col("__good"), F.col(f"__j.{d}"))).alias(d) for d in JUDGE_DIMENSIONS],
    )


def is_json_object(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull() & F.startswith(F.ltrim(text), F.lit("{"))


def is_json(text: Column, required: list[str] | None = None) -> Column:
    """An object or a list; with ``required`` an object that holds these fields."""
    ok = F.try_parse_json(text).isNotNull() & F.ltrim(text).rlike(r"^[\[{]")
    if required:
        keys = F.coalesce(F.json_object_keys(text), F.expr("cast(array() as array<string>)"))
        ok = ok & (F.size(F.array_except(F.array(*[F.lit(r) for r in required]), keys)) == 0)
    return F.coalesce(ok, F.lit(False))


def is_markdown(text: Column) -> Column:
    """Any heading, list, emphasis or fenced block."""
    return text.rlike(r"(?m)^(#{1,6} |[-*] |\d+\. |```)|\*\*[^*]+\*\*")


def burn_rates(traces: DataFrame, checks: dict[str, tuple[Column, float]], ts: str = "ts") -> DataFrame:
    """Error budget use per day: ``checks`` maps a name to (bad condition, allowed share)."""
    long = traces.select(
        truncated("day", ts).alias("day"),
        F.inline(F.array(*[F.struct(F.lit(n).alias("slo"), c.cast("int").alias("bad"), F.lit(a).alias("allowed")) for n, (c, a) in checks.items()])),
    )
    used = F.sum("bad") / F.count("*") / F.max("allowed")
    return long.groupBy("day", "slo").agg(
        F.sum("bad").alias("bad"), F.count("*").alias("total"), used.alias("burn"), (1 - used).alias("remaining")
    )


def _unit(responses: DataFrame, keep: list[str], embedding: str) -> DataFrame:
    """Unit vectors as rows (dimension i, component u); a zero vector stays zero."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    rows = responses.select(*keep, v.alias("__v"), norm.alias("__n")).select(*keep, "__n", F.posexplode_outer("__v").alias("i", "x"))
    return rows.where(F.col("i").isNotNull()).select(*keep, "i", F.coalesce(F.col("x") / F.nullif(F.col("__n"), F.lit(0.0)), F.lit(0.0)).alias("u"))


def unit_sums(responses: DataFrame, group: str, embedding: str) -> DataFrame:
    """Per group and dimension the sum of unit vectors; combines before the shuffle."""
    return _unit(responses, [group], embedding).groupBy(group, "i").agg(
        F.sum("u").alias("s"), F.sum(F.col("u") * F.col("u")).alias("q"), F.count("*").alias("n")
    )


def self_consistency(responses: DataFrame, group: str, embedding: str) -> DataFrame:
    """Mean cosine over all unordered pairs, without forming pairs.

    The pair sum of vectors u is (|sum u|^2 - sum |u|^2) / 2, so one linear pass is enough.
    """
    per = unit_sums(responses, group, embedding).groupBy(group).agg(
        F.max("n").alias("n"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("q").alias("q")
    )
    score = (F.col("ss") - F.col("q")) / (F.col("n") * (F.col("n") - 1))
    return per.select(group, "n", F.when(F.col("n") > 1, score).alias("score"))


def similarity_to_others(responses: DataFrame, group: str, item: str, embedding: str) -> DataFrame:
    """Mean cosine of each response to the other ones of its group (row means of the pair matrix)."""
    sums = unit_sums(responses, group, embedding).groupBy(group).agg(
        F.max("n").alias("__m"), F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("__s")
    )
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    unit = F.transform(v, lambda x: F.coalesce(x / F.nullif(norm, F.lit(0.0)), F.lit(0.0)))
    # one vector per group on the right, one join per response
    rows = responses.select(group, item, unit.alias("__u")).join(sums, group)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, x: t + x)
    dot, own = total(F.zip_with("__u", "__s", lambda a, b: a * b)), total(F.transform("__u", lambda a: a * a))
    return rows.select(group, item, F.when(F.col("__m") > 1, (dot - own) / (F.col("__m") - 1)).alias("mean_similarity"))
