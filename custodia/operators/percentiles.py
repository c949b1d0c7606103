"""Exact percentiles per group without holding a large group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Cells of a histogram to each factor e, so a cell spans 0.1 %; values closer to zero than the inverse scale share the first cell.
CELLS, SCALE = 1024, 1e6


def _ranks(p: float, n: Column, how: str) -> tuple[Column, Column, Column]:
    """0-based lower rank, upper rank and weight of the upper one."""
    if how == "index":
        if not 0 <= p < 1:
            raise ValueError("an index percentile needs 0 <= p < 1")
        k = F.floor(n * F.lit(p))
        return k, k, F.lit(0.0)
    pos = (n - 1) * F.lit(p)
    low = F.floor(pos)
    return low, F.ceil(pos), pos - low


def same_keys(left: DataFrame, right: DataFrame, names: dict[str, str]) -> Column:
    """Join condition under which NULL meets NULL."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in names.items()])


def join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of two tables with one row per key, NULL keys included."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one row each
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    return left.join(other, same_keys(left, other, {k: f"__r_{k}" for k in keys})).drop(*[f"__r_{k}" for k in keys])


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], how: str = "linear") -> DataFrame:
    """Percentiles of ``value`` per key, plus the number of values ``n``.

    ``linear`` interpolates between ranks; ``index`` takes the element at
    ``int(n * p)`` of the sorted values. NULL keys are a group.
    """
    return ranked(df, keys, value, {name: (p, how) for name, p in probs.items()}).drop("mean")


def _cell(v: Column) -> Column:
    """Number of a value's cell, never falling as values rise: equal steps of the logarithm, mirrored below zero."""
    steps = F.floor(F.log1p(F.abs(v) * SCALE) * CELLS)
    return F.when(F.isnan(v), F.lit(2**63 - 1)).when(v < 0, -steps).otherwise(steps)


def ranked(df: DataFrame, keys: list[str], value: str, wanted: dict[str, tuple[float, str]]) -> DataFrame:
    """``n``, ``mean`` and, for each name, the percentile of a probability by a rule, from one bracketing.

    A histogram of cells is counted first, combined before its shuffle; it tells in which cell each wanted rank lies.
    Only the values of those cells are shuffled, equal ones as one, and cut at the rank that is left in their cell.
    """
    names = list(wanted)
    src = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    src = src.withColumn("__cell", _cell(F.col("__v")))
    counted = src.groupBy(*keys, "__cell").agg(F.count("*").alias("__c"), F.sum("__v").alias("__s"))
    group = W.partitionBy(*keys)
    upto = group.orderBy("__cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    cells = counted.withColumns({"__end": F.sum("__c").over(upto), "n": F.sum("__c").over(group), "__total": F.sum("__s").over(group)})
    ranks, weights = [], {}
    for i, name in enumerate(names):
        low, high, weights[name] = _ranks(wanted[name][0], F.col("n"), wanted[name][1])
        ranks += [F.struct(F.lit(2 * i).alias("i"), low.cast("bigint").alias("rank")), F.struct(F.lit(2 * i + 1).alias("i"), high.cast("bigint").alias("rank"))]
    start = F.col("__end") - F.col("__c")
    here = F.filter(F.array(*ranks), lambda r: (r["rank"] >= start) & (r["rank"] < F.col("__end")))
    places = F.transform(here, lambda r: F.struct(r["i"].alias("i"), (r["rank"] - start).alias("left")))
    # as many rows per key as there are wanted ranks at most
    sought = cells.withColumn("__at", places).where(F.size("__at") > 0).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__cell").alias("__k_cell"), "n", (F.col("__total") / F.col("n")).alias("mean"), "__at"
    )
    on = src["__cell"] == sought["__k_cell"]
    if keys:
        on = on & same_keys(src, sought, {k: f"__k_{k}" for k in keys})
    near = src.join(sought, on).groupBy(*keys, "__cell", "__v").agg(F.count("*").alias("__c"), *[F.first(c).alias(c) for c in ("n", "mean", "__at")])
    order = W.partitionBy(*keys, "__cell").orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow)
    hits = near.withColumn("__end", F.sum("__c").over(order)).select(*keys, "n", "mean", "__v", "__end", "__c", F.explode("__at").alias("r"))
    hits = hits.where((F.col("r.left") < F.col("__end")) & (F.col("r.left") >= F.col("__end") - F.col("__c")))
    found = hits.groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("mean").alias("mean"), *[F.max(F.when(F.col("r.i") == i, F.col("__v"))).alias(f"__r{i}") for i in range(2 * len(names))]
    )
    out = []
    for i, name in enumerate(names):
        low, high = F.col(f"__r{2 * i}"), F.col(f"__r{2 * i + 1}")
        out.append(F.when(low == high, low).otherwise(low * (1 - weights[name]) + high * weights[name]).alias(name))
    done = found.select(*keys, "n", "mean", *out)
    return done if keys else done.where("n IS NOT NULL")
