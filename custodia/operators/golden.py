"""Golden set evaluation, model comparison, regression and promotion gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.sources import dims


def has_facts(answer: Column, facts: Column) -> Column:
    return F.forall(facts, lambda f: F.contains(answer, f))


def evaluate(runs: DataFrame, golden: DataFrame, item: str = "item_id") -> DataFrame:
    """Runs with their reference record; passed when all facts occur and the score suffices. A run without answer, score or
    facts to compare with has not passed."""
    g = golden.select(item, "required_facts", "min_score")
    j = runs.join(g, item)
    facts = F.coalesce(has_facts(F.col("response"), F.col("required_facts")), F.lit(False))
    enough = F.coalesce(F.col("score") >= F.col("min_score"), F.lit(False))
    return j.withColumn("facts_ok", facts).withColumn("passed", F.col("facts_ok") & enough)


def compare(runs: DataFrame, a: str, b: str, item: str = "item_id") -> DataFrame:
    """Scores of two models side by side, one aggregation instead of a self join."""
    side = runs.where(F.col("model_id").isin(a, b)).groupBy(item).agg(
        F.max(F.when(F.col("model_id") == a, F.col("score"))).alias("score_a"), F.max(F.when(F.col("model_id") == b, F.col("score"))).alias("score_b")
    )
    return side.where(F.col("score_a").isNotNull() & F.col("score_b").isNotNull()).withColumn("delta", F.col("score_b") - F.col("score_a"))


def regressions(versions: DataFrame, ratio: float = dims.DROP_RATIO) -> DataFrame:
    """Each version against the one deployed before it (the registry holds few rows per model)."""
    w = W.partitionBy("model_id").orderBy("deployed")
    v = versions.withColumns({"prev_score": F.lag("eval_score").over(w), "prev_rate": F.lag("hallucination_rate").over(w)})
    drop = (F.col("prev_score") - F.col("eval_score")) / F.nullif(F.col("prev_score"), F.lit(0.0))
    rise = (F.col("hallucination_rate") - F.col("prev_rate")) / F.nullif(F.col("prev_rate"), F.lit(0.0))
    return v.withColumns({"score_drop": drop, "rate_rise": rise}).withColumn(
        "regressed", F.coalesce(F.col("score_drop") > ratio, F.lit(False)) | F.coalesce(F.col("rate_rise") > ratio, F.lit(False))
    )


def smoke(evaluated: DataFrame, n: int = 5, item: str = "item_id") -> DataFrame:
    """Do the first ``n`` items pass? The sample size is the feature. No item at all is no pass."""
    first = evaluated.orderBy(item).limit(n)
    return first.agg(F.count("*").alias("items"), F.coalesce(F.every(F.coalesce("passed", F.lit(False))), F.lit(False)).alias("passed"))
