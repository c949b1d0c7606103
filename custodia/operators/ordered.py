"""Running values and neighbours in an order, also when one key holds most rows.

A plain window sends each key to one task. Here the rows are range
partitioned by (keys, order), so a hot key spreads over many chunks; their number follows
the size of the data. Each chunk computes its own running values and a small table of chunk
totals supplies what came before. There is one path for all sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.session import pinned

_COMBINE = {
    "sum": lambda carry, local: F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local),
    "max": lambda carry, local: F.greatest(carry, local),
    "min": lambda carry, local: F.least(carry, local),
}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def ordered_window(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    running: dict[str, tuple[str, Column]] | None = None,
    lag: dict[str, Column] | None = None,
    lead: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running sum/max/min (current row included) and previous/next values.

    ``order`` must be unique within a key. Without keys the order is global.
    """
    running, lag, lead = running or {}, lag or {}, lead or {}
    # Materialised: totals and rows below must see the same chunk boundaries.
    chunked = pinned(df.repartitionByRange(*keys, *order).withColumn("__chunk", F.spark_partition_id()))
    w = W.partitionBy("__chunk", *keys).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = {f"__l_{i}": _AGG[f](c).over(upto) for i, (f, c) in enumerate(running.values())}
    # a struct tells "first row of the chunk" from "previous value is NULL"
    local |= {f"__g_{i}": F.lag(F.struct(c.alias("v"))).over(w) for i, c in enumerate(lag.values())}
    local |= {f"__d_{i}": F.lead(F.struct(c.alias("v"))).over(w) for i, c in enumerate(lead.values())}
    rows = chunked.withColumns(local)

    totals = [_AGG[f](c).alias(f"__l_{i}") for i, (f, c) in enumerate(running.values())]
    totals += [F.max_by(F.struct(c.alias("v")), F.struct(*order)).alias(f"__g_{i}") for i, c in enumerate(lag.values())]
    totals += [F.min_by(F.struct(c.alias("v")), F.struct(*order)).alias(f"__d_{i}") for i, c in enumerate(lead.values())]
    # one row per (chunk, key)
    carry = chunked.groupBy("__chunk", *keys).agg(*totals)
    cw = W.partitionBy(*keys).orderBy("__chunk")
    before = cw.rowsBetween(W.unboundedPreceding, -1)
    carried = [_AGG[f](F.col(f"__l_{i}")).over(before).alias(f"__cl_{i}") for i, (f, _) in enumerate(running.values())]
    carried += [F.lag(f"__g_{i}").over(cw).alias(f"__cg_{i}") for i in range(len(lag))]
    carried += [F.lead(f"__d_{i}").over(cw).alias(f"__cd_{i}") for i in range(len(lead))]
    carry = carry.select(F.col("__chunk").alias("__c"), *[F.col(k).alias(f"__k_{k}") for k in keys], *carried)

    on = rows["__chunk"] == carry["__c"]
    for k in keys:
        on = on & rows[k].eqNullSafe(carry[f"__k_{k}"])
    joined = rows.join(carry, on, "left")
    out = {name: _COMBINE[f](F.col(f"__cl_{i}"), F.col(f"__l_{i}")) for i, (name, (f, _)) in enumerate(running.items())}
    out |= {name: F.coalesce(f"__g_{i}", f"__cg_{i}")["v"] for i, name in enumerate(lag)}
    out |= {name: F.coalesce(f"__d_{i}", f"__cd_{i}")["v"] for i, name in enumerate(lead)}
    return joined.withColumns(out).select(*df.columns, *running, *lag, *lead)


def trailing_count(events: DataFrame, keys: list[str], ts: str, width: str | Column, weight: str | None = None) -> DataFrame:
    """Per key and distinct time: events at that time (``n``) and in the trailing
    closed interval ``[ts - width, ts]`` (``n_trailing``). A row stands for ``weight`` events; ``width`` may use the keys.

    A difference of two running sums: one at each time, one just before the start
    of its interval. No range frame, so a hot key can be split.
    """
    before = width if isinstance(width, Column) else F.expr(f"INTERVAL {width}")
    cells = events.groupBy(*keys, ts).agg((F.count("*") if weight is None else F.sum(weight)).alias("n"))
    points = cells.select(
        *keys, "n", F.col(ts).alias("__at"),
        F.explode(
            F.array(
                # the start point sorts before the events of its own instant
                F.struct((F.col(ts) - before).alias("t"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("add")),
                F.struct(F.col(ts).alias("t"), F.lit(1).alias("kind"), F.col("n").alias("add")),
            )
        ).alias("p"),
    ).select(*keys, "n", "__at", "p.t", "p.kind", "p.add")
    summed = ordered_window(points, keys, ["t", "kind"], running={"__run": ("sum", F.col("add"))})
    return (
        summed.groupBy(*keys, "__at")
        .agg(
            F.max("n").alias("n"),
            (F.max(F.when(F.col("kind") == 1, F.col("__run"))) - F.max(F.when(F.col("kind") == 0, F.col("__run")))).alias("n_trailing"),
        )
        .withColumnRenamed("__at", ts)
    )
