"""The training-data pipeline over ``documents``: one stage after another, each on all that its predecessor kept.

Every stage takes the documents of the stage before and returns those it keeps with their columns; the last one returns their tokens.
A stage's odd inputs are those of its operator. The near-dedup stage judges rows, not ids: a repeated row is a copy, of which it
keeps one, also among rows with a null id, and rows of one id with different texts are different documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.llm import bpe, decontaminate, minhash, quality, toxicity
from custodia.llm.common import dropped, stored, table
from custodia.llm.queries import TOKENIZER, quality_model, toxicity_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    scored = toxicity.apply(docs, toxicity_model(spark, sf_dir, docs))
    return scored.where("__predicted = 0").select(docs.columns)


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = quality.apply(docs, quality_model(spark, sf_dir, docs))
    return scored.where("__predicted = 1").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id; null ids come last."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("__hash")]
    # written once, so that a row keeps its key; keys follow the ids
    numbered = docs.withColumn("__hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id())
    rows = stored(numbered, "numbered")
    judged = minhash.near_duplicates(rows, "__row").where("kept").select("__row", "n_shingles")
    # texts without shingles have no near duplicates; copies of a row are one here too
    group = F.when(F.col("n_shingles") > 0, F.col("__row"))
    kept = judged.join(rows.select("__row", "doc_id", "__hash"), "__row").groupBy("doc_id", "__hash", group).agg(F.min("__row").alias("__row")).select("__row")
    return rows.join(kept, "__row").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, joined by commas, their number, and a digest of the bytes decoded from them."""
    # after the other stages an executor has less memory to spare than for the operator alone
    done = bpe.encode_decode(docs, TOKENIZER, memory=60_000)
    return done.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("quality", reject_low_quality),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("byte-bpe", encode),
]

#: The stages hold trained models, which SQL cannot express; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        if before is not source:
            dropped(before)
    return docs
