"""Grounding of response claims in context chunks by shared word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions import text as tx

THRESHOLD = 0.6
#: Chunks of one shingle that meet its claims in one place; longer posting lists are cut into blocks.
BLOCK = 1000


def claims(responses: DataFrame, doc_id: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """One row per sentence of a response."""
    return tx.unnest(responses, [doc_id, *(keep or [])], tx.sentences(F.col(text)), "claim", "ord")


def _shingled(df: DataFrame, keys: list[str], text: str, n: int) -> DataFrame:
    worded = df.select(*keys, tx.words(F.col(text)).alias("__w"))
    return worded.select(*keys, tx.shingles(F.col("__w"), n).alias("sh"))


def _blocks(df: Column) -> Column:
    return F.ceil(df / BLOCK).cast("int")


def _blocked(postings: DataFrame, freq: DataFrame, scope: list[str]) -> DataFrame:
    """Postings with the block of their list; only long lists have more than one."""
    long = freq.where(F.col("df") > BLOCK).select(*scope, "s", _blocks(F.col("df")).alias("of"))
    dealt = postings.join(long, [*scope, "s"], "left")
    return dealt.withColumn("block", F.coalesce(F.pmod(F.xxhash64("__chunk"), F.col("of")).cast("int"), F.lit(0))).drop("of")


def supported_claims(
    claim_rows: DataFrame, chunks: DataFrame, claim: str, chunk_id: str, chunk_text: str,
    scope: list[str] | None = None, threshold: float = THRESHOLD, n: int = 3,
) -> DataFrame:
    """Distinct claims (by digest, within ``scope``) of which one chunk holds at least ``threshold`` of the shingles.

    Exact, without comparing every claim to every chunk. A claim of m shingles
    needs t = ceil(threshold * m) of them in one chunk, so one of its m - t + 1
    rarest shingles must be there: only those are joined. Copies of a claim or a
    chunk are looked at once, a chunk with fewer than t shingles meets no claim, and a frequent shingle is never joined while the
    claim has rarer ones. A shingle that stands in very many chunks has its list cut into blocks, each of which the
    claims meet apart, so no task holds one list. With ``scope`` (a request, a tenant) a claim meets its own chunks only.
    """
    scope = scope or []
    uniq = claim_rows.select(*scope, F.col(claim).alias("__t")).distinct()
    left = _shingled(uniq.withColumn("claim_key", F.sha2("__t", 256)), [*scope, "claim_key"], "__t", n)
    ctx = chunks.select(*scope, F.col(chunk_text).alias("__t")).distinct().withColumn("__chunk", F.sha2("__t", 256))
    right = _shingled(ctx, [*scope, "__chunk"], "__t", n)
    postings = right.select(*scope, "__chunk", F.size("sh").alias("held"), F.explode_outer("sh").alias("s"))
    freq = postings.groupBy(*scope, "s").agg(F.count("*").alias("df"))
    postings = _blocked(postings, freq, scope)

    # shingles of no chunk drop out here, which is most of them
    ranked = (
        left.select(*scope, "claim_key", F.size("sh").alias("m"), F.explode_outer("sh").alias("s"))
        .join(freq, [*scope, "s"])
        .groupBy(*scope, "claim_key", "m")
        # as many entries as the sentence has words
        .agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("known"))
        .withColumn("need", F.ceil(F.round(F.col("m") * threshold, 9)).cast("int"))
        .where(F.size("known") >= F.col("need"))
    )
    # shingles absent from every chunk are the rarest; they use up m - |known| places of the prefix
    places = F.size("known") - F.col("need") + 1
    probes = ranked.select(
        *scope, "claim_key", "need", F.transform("known", lambda k: k["s"]).alias("c_sh"),
        F.explode(F.slice("known", F.lit(1), places)).alias("p"),
    ).select(*scope, "claim_key", "need", "c_sh", F.col("p.s").alias("s"), F.explode(F.sequence(F.lit(0), _blocks(F.col("p.df")) - 1)).alias("block"))
    pairs = probes.join(postings, [*scope, "s", "block"]).where("held >= need").groupBy(*scope, "claim_key", "__chunk").agg(
        F.first("need").alias("need"), F.first("c_sh").alias("c_sh")
    )
    verified = pairs.join(right, [*scope, "__chunk"]).where(F.size(F.array_intersect("c_sh", "sh")) >= F.col("need"))
    return verified.select(*scope, "claim_key").distinct()


def ground(
    claim_rows: DataFrame, chunks: DataFrame, claim: str = "claim", chunk_id: str = "chunk_id", chunk_text: str = "chunk",
    scope: list[str] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """Add ``supported`` to every claim."""
    scope = scope or []
    good = supported_claims(claim_rows, chunks, claim, chunk_id, chunk_text, scope, threshold).withColumn("__ok", F.lit(True))
    keyed = claim_rows.withColumn("claim_key", F.sha2(F.col(claim), 256))
    return keyed.join(good, [*scope, "claim_key"], "left").select(*claim_rows.columns, F.coalesce("__ok", F.lit(False)).alias("supported"))


def scores(grounded: DataFrame, keys: list[str]) -> DataFrame:
    return grounded.groupBy(*keys).agg(
        F.count("*").alias("claims"), F.sum(F.col("supported").cast("int")).alias("supported"), F.avg(F.col("supported").cast("int")).alias("score")
    )


def heatmap(grounded: DataFrame, row: str, column: str, columns: list[str]) -> DataFrame:
    return grounded.groupBy(row).pivot(column, columns).agg(F.avg(F.col("supported").cast("int")))
