"""Typed sources, batch or streaming, in any format Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.sources import schemas


def read(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", streaming: bool = False, **options) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).format(fmt).options(**options).load(path)


def prompts(spark: SparkSession, path: str, **options) -> DataFrame:
    """Prompt requests; absent lists become empty ones."""
    empty = F.expr("cast(array() as array<string>)")
    df = read(spark, path, schemas.PROMPTS, **options)
    return df.withColumns({c: F.coalesce(c, empty) for c in ("approved_datasets", "approved_tools")})


def traces(spark: SparkSession, path: str, **options) -> DataFrame:
    """Inference traces; the short task name is normalised."""
    df = read(spark, path, schemas.TRACES, **options).withColumnRenamed("timestamp", "ts")
    return df.withColumn("task_type", F.when(F.col("task_type") == "rag", "rag_query").otherwise(F.col("task_type")))


def golden_set(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    df = read(spark, path, schemas.GOLDEN, fmt, **options)
    return df.select(
        F.col("id").alias("item_id"), "task_type", "prompt", "context_chunks", "reference_answer",
        F.col("acceptable_range.min_score").alias("min_score"), F.col("acceptable_range.required_facts").alias("required_facts"), "tags",
    )


def messages(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Agent messages under the column names of the operators; the time to live defaults to five minutes."""
    df = read(spark, path, schemas.MESSAGES, fmt, **options)
    return df.select(
        "message_id", F.col("sender_agent").alias("sender"), F.col("recipient_agent").alias("recipient"), F.col("task_type").alias("message_type"),
        "payload", "context", "trace_id", "created_at", F.coalesce("ttl_seconds", F.lit(300)).alias("ttl_seconds"),
    )


def tool_calls(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    return read(spark, path, schemas.TOOL_CALLS, fmt, **options)


def claims(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Verified token claims with the fields access checks need."""
    c = F.col("claims")
    df = read(spark, path, schemas.CLAIMS, fmt, **options)
    return df.select("request_id", c["x-user-role"].alias("x_user_role"), c["role"].alias("role_claim"), c["sub"].alias("sub"), c["sid"].alias("sid"))


def audit_log(spark: SparkSession, path: str, since: str | None = None, **options) -> DataFrame:
    """The partitioned log; ``since`` (a date) prunes partitions."""
    df = read(spark, path, schemas.AUDIT + ", dt DATE", **options)
    return df if since is None else df.where(F.col("dt") >= F.lit(since).cast("date"))
