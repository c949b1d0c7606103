"""Append-only log: duplicates ignored, gate on reads, nothing changes."""

import pytest
from pyspark.sql import functions as F

from custodia.operators import audit
from custodia.sources import readers, sinks
from custodia.streaming.sinks import append_audit

SCHEMA = "event_id string, ts timestamp, user_id string, user_role string, session_id string, latency_ms bigint, n int"


def records(spark, rows):
    df = spark.createDataFrame(rows, "event_id string, s int, user_id string, latency_ms bigint, n int")
    return df.select(
        "event_id", (F.expr("TIMESTAMP '2024-01-01 00:00:00'") + F.make_dt_interval(secs=F.col("s"))).alias("ts"), "user_id",
        F.lit("ANALYST").alias("user_role"), F.lit("s").alias("session_id"), "latency_ms", "n",
    )


def test_duplicate_keeps_first(spark):
    df = records(spark, [("e1", 0, "u", 10, 0), ("e1", 5, "u", 9999, 1), ("e2", 1, None, 1, 2), ("e2", 9, "u", 2, 3)])
    got = {r["event_id"]: r["latency_ms"] for r in audit.first_per_event(df, ["ts", "n"]).collect()}
    assert got == {"e1": 10, "e2": 2}
    assert audit.rejected(df).count() == 1


def test_gate():
    for role in ("VIEWER", "ANALYST", "DEVELOPER", "", None):
        with pytest.raises(PermissionError):
            audit.check_reader(role)
    audit.check_reader("SUPER_ADMIN")


def test_page_and_sequence(spark):
    df = records(spark, [(f"e{i}", i, "u", i, i) for i in range(25)])
    ids = {r["event_id"]: r["id"] for r in audit.with_sequence(df, ["ts", "event_id"], start=100).collect()}
    assert ids == {f"e{i}": 101 + i for i in range(25)}
    page = [r["event_id"] for r in audit.page(df, "PLATFORM_ADMIN", ["ts", "event_id"], limit=3, offset=2).collect()]
    assert page == ["e22", "e21", "e20"]
    assert audit.page(df, "PLATFORM_ADMIN", ["ts"], limit=-1, offset=20).count() == 5
    every = [r["event_id"] for r in audit.page(df, "PLATFORM_ADMIN", ["ts", "event_id"], limit=-1).collect()]
    assert [r["event_id"] for r in audit.page(df, "PLATFORM_ADMIN", ["ts", "event_id"], limit=-1, offset=20).collect()] == every[20:]
    assert [r["event_id"] for r in audit.page(df, "PLATFORM_ADMIN", ["ts", "event_id"], limit=20_000, offset=22).collect()] == every[22:]
    last = audit.page(df, "PLATFORM_ADMIN", ["ts", "event_id"], limit=3).collect()[-1]
    assert [r["event_id"] for r in audit.page(df, "PLATFORM_ADMIN", ["ts", "event_id"], limit=4, after=(last["ts"], last["event_id"])).collect()] == every[3:7]


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None)], "model_id string, latency_ms bigint, tool_calls array<string>")
    assert tuple(audit.with_defaults(df).first()) == ("", 0, [])


def test_immutability(spark):
    old = records(spark, [("a", 0, "u", 1, 0), ("b", 0, "u", 1, 0), ("c", 0, "u", 1, 0)])
    new = records(spark, [("a", 0, "u", 1, 0), ("b", 0, "u", 2, 0), ("d", 0, "u", 1, 0)])
    assert {r["event_id"] for r in audit.altered_rows(old, new).collect()} == {"b", "c"}


def test_append_sink_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "log")
    full = "event_id string, ts timestamp, user_id string, user_role string, session_id string, latency_ms bigint, tool_calls array<string>"
    def batch(ids, latency):
        df = spark.createDataFrame([(i, "u", "ANALYST", "s", latency) for i in ids], "event_id string, user_id string, user_role string, session_id string, latency_ms bigint")
        df = df.withColumns({"ts": F.expr("TIMESTAMP '2024-01-01 10:00:00'"), "tool_calls": F.lit(None).cast("array<string>")})
        return df.select(*[c.split()[0] for c in full.split(", ")])

    sinks.append_audit(batch([f"e{i}" for i in range(50)], 10), path)
    sinks.append_audit(batch(["e1", "e50", None], 9999), path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 51
    assert {r["event_id"]: r["latency_ms"] for r in rows}["e1"] == 10
    assert all(r["tool_calls"] == [] for r in rows)
    assert readers.audit_log(spark, path, since="2024-01-02").count() == 0
    text = sinks.lists_to_json(spark.read.parquet(path), ["tool_calls"])
    assert text.first()["tool_calls"] == "[]"
    assert sinks.lists_from_json(text, ["tool_calls"]).first()["tool_calls"] == []


def test_stream_step_survives_a_rerun(spark, tmp_path):
    step = append_audit(str(tmp_path), ["ts", "n"])
    first = records(spark, [("a", 0, "u", 1, 0), ("b", 1, "u", 1, 1)])
    step(first, 0)
    step(first, 0)  # the same batch again, as after a lost commit
    step(records(spark, [("b", 0, "u", 7, 0), ("c", 90000, "u", 7, 1)]), 1)
    got = {r["event_id"]: r["latency_ms"] for r in spark.read.parquet(f"{tmp_path}/log").collect()}
    assert got == {"a": 1, "b": 1, "c": 7}


def test_token_sink(spark, tmp_path):
    from custodia.operators import tokens

    def puts(rows):
        df = spark.createDataFrame(rows, "token string, value string, type string, session string, s int")
        return tokens.puts_of(df.withColumn("at", F.expr("TIMESTAMP '2024-01-01 00:00:00'") + F.make_dt_interval(secs=F.col("s"))), "session", "at")

    path = str(tmp_path / "tokens")
    sinks.append_tokens(puts([("t", "first@example.com", "EMAIL", "s1", 0)]), path)
    sinks.append_tokens(puts([("t", "second@example.com", "EMAIL", "s2", 60), ("u", "x", "SSN", "s1", 60)]), path)
    assert {r["token"]: r["value"] for r in spark.read.parquet(path).collect()} == {"t": "first@example.com", "u": "x"}
    ended = spark.createDataFrame([("s1",)], "session_id string")
    assert sinks.drop_sessions(path, ended, str(tmp_path / "tokens2")) == 2


def test_token_stream_step(spark, tmp_path):
    from custodia.operators import tokens
    from custodia.streaming.sinks import append_token_map

    def puts(rows):
        df = spark.createDataFrame(rows, "token string, value string, s int").withColumns(
            {"type": F.lit("EMAIL"), "session": F.lit("s"), "at": F.expr("TIMESTAMP '2024-01-01 23:30:00'") + F.make_dt_interval(secs=F.col("s"))})
        return tokens.puts_of(df, "session", "at")

    step = append_token_map(str(tmp_path))
    first = puts([("t", "a", 0), ("t", "b", 5)])
    step(first, 0)
    step(first, 0)
    step(puts([("t", "late", 3599), ("t", "again", 3600), ("u", "x", 3000)]), 1)
    got = sorted(r["value"] for r in spark.read.parquet(f"{tmp_path}/map").collect())
    assert got == ["a", "again", "x"]


def test_retention_prunes_days(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id").alias("event_id"), (F.expr("TIMESTAMP '2015-01-01 00:00:00'") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("ts"))
    rows.withColumn("dt", F.trunc("ts", "year")).write.partitionBy("dt").parquet(str(tmp_path / "log"))
    kept = audit.retained(spark.read.parquet(str(tmp_path / "log")), "2025-01-01 00:00:00")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and kept.count() == rows.where("ts >= TIMESTAMP '2023-01-01 00:00:00'").count()


def test_a_longer_time_to_live_still_blocks(spark, tmp_path):
    """A record outlives the puts' own time to live: it was written before that was shortened."""
    from custodia.operators import tokens

    df = spark.createDataFrame([("t", "first", "EMAIL", "s", 0), ("t", "second", "EMAIL", "s", 4 * 86400), ("t", "third", "EMAIL", "s", 7 * 86400)], "token string, value string, type string, session string, s int")
    df = df.withColumn("at", F.expr("TIMESTAMP '2024-01-01 12:00:00'") + F.make_dt_interval(secs=F.col("s")))
    path = str(tmp_path / "map")
    for value, ttl in (("first", 7 * 86400), ("second", 3600), ("third", 3600)):
        sinks.append_tokens(tokens.puts_of(df.where(F.col("value") == value), "session", "at", ttl), path)
    assert sorted(r["value"] for r in spark.read.parquet(path).collect()) == ["first", "third"]
