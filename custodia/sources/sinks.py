"""Append-only sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.operators import audit, tokens
from custodia.session import pinned
from custodia.sources import schemas
from custodia.streaming.sinks import append_by_day, table_or_none


def append_audit(records: DataFrame, path: str, order: list[str] | None = None) -> int:
    """Append the events the log does not hold yet; returns the number of incomplete records left out."""
    spark = records.sparkSession
    rows = audit.with_defaults(records).withColumn("dt", F.to_date("ts"))
    order = order or ["ts", "latency_ms"]
    log = table_or_none(spark, path, rows.schema)
    new = audit.first_per_event(rows, order) if log is None else audit.new_rows(log, rows, order)
    # pinned: the append must not read files it is adding
    append_by_day(pinned(new), path)
    return audit.rejected(rows).count()


def append_tokens(puts: DataFrame, path: str, same_session: bool = False) -> None:
    """Append token records, write-once while alive; partitioned by day of creation."""
    spark = puts.sparkSession
    existing = table_or_none(spark, path, schemas.TOKEN_MAP + ", dt DATE")
    if existing is not None:
        existing = tokens.living(existing, puts)
    new = tokens.write_once(existing, puts, same_session)
    append_by_day(pinned(new).withColumn("dt", F.to_date("created_at")), path)


def drop_sessions(path: str, ended: DataFrame, target: str) -> int:
    """Write the map without ended sessions to ``target``; returns how many records went."""
    spark = ended.sparkSession
    old = spark.read.schema(schemas.TOKEN_MAP + ", dt DATE").parquet(path)
    append_by_day(tokens.without_sessions(old, ended), target, "overwrite")
    return old.join(ended.select("session_id").distinct(), "session_id", "left_semi").count()


def write_report(report: DataFrame, path: str) -> None:
    """The JSON report as a text file."""
    report.select(F.col("report").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def lists_to_json(df: DataFrame, columns: list[str]) -> DataFrame:
    """Arrays as JSON text, for stores without array columns."""
    return df.withColumns({c: F.to_json(F.col(c)) for c in columns})


def lists_from_json(df: DataFrame, columns: list[str]) -> DataFrame:
    def parsed(c: str) -> Column:
        return F.coalesce(F.from_json(F.col(c), "array<string>"), F.expr("cast(array() as array<string>)"))

    return df.withColumns({c: parsed(c) for c in columns})
