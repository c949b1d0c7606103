"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import dropped, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


#: Edges of a node that meet its minimum in one place.
SALT_EDGES = 1000


def _salts():
    return F.ceil(F.count("*") / SALT_EDGES).cast("int").alias("salts")


def _with_minimum(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Edges with the minimum ``m`` of their node; only hubs have more than one salt."""
    salted = low.select("u", "m", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "salts")
    hubs = low.where("salts > 1").select("u", F.col("salts").alias("of"))
    dealt = edges.join(hubs, "u", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("v"), F.col("of")).cast("int"), F.lit(0)))
    return dealt.join(salted.select("u", "salt", "m"), ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    A large-star step hangs each node's larger neighbours on its smallest one, a small-star step the
    smaller ones. Minima are aggregated before the shuffle. A hub's edges are joined back in parts: its minimum is
    given to as many salts as it has thousands of neighbours. Each step's edges are written once and those of the step
    before are deleted; a round in one plan would hold the large-star step four times, and the driver's memory would go
    by the size of plans. Loops and repeated edges do no harm; edges with a null end are no links.
    """
    ends = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).where("a is not null and b is not null")
    clean = ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = stored(clean.where("u <> v").distinct(), "edges")
    before = _state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), _salts()).select("u", F.least("u", "m").alias("m"), "salts")
        step = _with_minimum(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(step, "large")
        dropped(current)
        small_low = large.groupBy("u").agg(F.min("v").alias("m"), _salts())
        small = _with_minimum(large, small_low).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        extra = small_low.select("u", F.col("m").alias("v"))
        current = stored(small.unionByName(extra).where("u <> v").distinct(), "edges")
        dropped(large)
        after = _state(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
