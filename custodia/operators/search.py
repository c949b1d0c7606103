"""Ranked search over a partitioned inverted index in shared storage.

The index holds one row per (term, item): how often the term occurs in the item, the item's length, author and time. Rows are partitioned
by a hash of the term and sorted by term within a file, so a search opens the partitions of its own terms only, and in them the row groups
that may hold them. Appends add files and one row of totals; nothing is rewritten. A frequent term's rows are split over many files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions import text as tx
from custodia.session import pinned
from custodia.streaming.reorder import folder

PARTS = 64
#: Weights of the usual ranking by term frequency and length (BM25).
K1, B = 1.2, 0.75


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def append(items: DataFrame, path: str, item: list[str], text: str, author: str, ts: str, parts: int = PARTS) -> None:
    """Add items to the index at ``path``. An item must be new; a null text is an item without words."""
    words = tx.words(F.col(text))
    rows = items.select(*item, F.col(author).alias("__author"), F.col(ts).alias("__ts"), F.coalesce(words, F.expr("cast(array() as array<string>)")).alias("__w"))
    rows = pinned(rows.withColumn("__length", F.size("__w")))
    terms = rows.select(*item, "__author", "__ts", "__length", F.explode("__w").alias("term"))
    postings = terms.groupBy(*item, "term").agg(F.count("*").alias("tf"), *[F.first(f"__{c}").alias(f"__{c}") for c in ("length", "author", "ts")])
    placed = postings.withColumn("part", _part(F.col("term"), parts)).hint("rebalance", "part").sortWithinPartitions("part", "term")
    placed.write.mode("append").partitionBy("part").parquet(f"{path}/postings")
    # totals come last: a failed append is not counted
    rows.agg(F.count("*").alias("items"), F.coalesce(F.sum("__length"), F.lit(0)).alias("words")).write.mode("append").parquet(f"{path}/totals")


def hits(spark: SparkSession, path: str, terms: list[str], parts: int = PARTS) -> DataFrame:
    """Index rows of the terms; only their partitions are read."""
    wanted = [(F.col("part") == _part(F.lit(t), parts)) & (F.col("term") == t) for t in sorted({t.lower() for t in terms})]
    return spark.read.parquet(f"{path}/postings").where(reduce(lambda a, b: a | b, wanted))


def search(
    spark: SparkSession, path: str, item: list[str], terms: list[str], k: int, author: str | None = None,
    since: Column | None = None, as_of: Column | None = None, half_life_days: float | None = None, parts: int = PARTS,
) -> DataFrame:
    """The ``k`` best items (the feature, not a cap): item, ``score`` and ``ts``.

    A term counts the more, the rarer it is and the shorter the item; ``author`` and ``since`` narrow the items, not the terms' weights.
    With ``half_life_days`` a score is halved for every such time between the item and ``as_of``. Ties: newest first, then by item.
    """
    if not terms:
        raise ValueError("a search needs a term")
    p, fs = folder(spark, f"{path}/postings")
    if not fs.exists(p):
        raise ValueError(f"no index at {path}")
    found = hits(spark, path, terms, parts)
    totals = spark.read.parquet(f"{path}/totals").agg(F.sum("items").alias("n"), (F.sum("words") / F.sum("items")).alias("avg_length"))
    held = found.groupBy("term").agg(F.count("*").alias("df"))  # as many rows as terms
    rows = found if author is None else found.where(F.col("__author") == author)
    rows = rows if since is None else rows.where(F.col("__ts") >= since)
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("__length") / F.col("avg_length"))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)
    if half_life_days is not None:
        days = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("__ts").cast("timestamp"))) / 86_400e6
        weight = weight * F.pow(F.lit(0.5), days / half_life_days)
    scored = rows.join(F.broadcast(held), "term").crossJoin(F.broadcast(totals)).groupBy(*item).agg(F.sum(weight).alias("score"), F.max("__ts").alias("ts"))
    return scored.orderBy(F.col("score").desc(), F.col("ts").desc(), *item).limit(k)
