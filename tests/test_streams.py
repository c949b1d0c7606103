"""Ordered micro-batch jobs against their batch twins, however the stream is cut."""

import random

import pytest
from pyspark.sql import functions as F

from custodia.operators import agents, quality, tokens
from custodia.sources import dims
from custodia.streaming import sinks
from custodia.streaming.reorder import late_rows

DELAY = 600


def shuffled(rows, at, seed):
    """Rows in an order in which none comes more than the delay after a newer one."""
    rnd = random.Random(seed)
    return sorted(rows, key=lambda r: r[at] + rnd.random() * (DELAY - 1))


def feed(spark, step, rows, schema, cuts, ts):
    """Batches of the rows; every second one is run twice, as after a failure."""
    edges = [0, *cuts, len(rows)]
    for epoch, (a, b) in enumerate(zip(edges, edges[1:])):
        batch = spark.createDataFrame(rows[a:b], schema).withColumn(ts, F.timestamp_seconds(ts))
        for _ in range(1 + epoch % 2):
            step(batch, epoch)


@pytest.mark.parametrize("cuts", [[200, 201, 201], [1, 300]])
def test_low_runs_do_not_depend_on_the_cut(spark, tmp_path, cuts):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot", "hot", "a", None]), 1000 + i * 7, i, rnd.choice([0.1, 0.2, None, 0.9] if i % 90 < 15 else [0.1])) for i in range(700)]
    schema = "m string, ts long, id long, s double"
    step = sinks.LowRuns(str(tmp_path), "m", "s", [("ts", "timestamp"), ("id", "bigint")], DELAY, longer_than=6)
    feed(spark, step, shuffled(rows, 1, 2), schema, cuts, "ts")
    step.finish(spark)
    table = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("ts"))
    want = sorted((r["m"] or "", r["started"], r["run_length"]) for r in quality.low_runs(table, "m", "s", ["ts", "id"], longer_than=6).collect())
    got = sorted((r["m"] or "", r["started"], r["run_length"]) for r in step.runs(spark).collect())
    assert got == want and len(want) > 5
    assert sorted((r["m"] or "", r["started"]) for r in step.alerts(spark).collect()) == [w[:2] for w in want]


@pytest.mark.parametrize("cuts", [[400, 401]])
def test_rate_limits_do_not_depend_on_the_cut(spark, tmp_path, cuts):
    registry = spark.createDataFrame([("day", "12/day"), ("hour", "5/hour"), ("minute", "2/minute"), ("second", "1/second")], "tool string, rate_limit string")
    rnd = random.Random(3)
    # bursts that lie across the edges of any fixed grid
    rows = [(rnd.choice(["a", "a", "b"]), rnd.choice(["day", "hour", "minute", "second", "none"]), 86_000 + i // 50 * 5000 + rnd.randrange(400)) for i in range(1500)]
    schema = "agent string, tool string, ts long"
    step = sinks.RateLimit(str(tmp_path), registry, DELAY)
    feed(spark, step, shuffled(rows, 2, 4), schema, cuts, "ts")
    step.finish(spark)
    batch = agents.over_rate_limit(spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("ts")), registry)
    want = sorted(map(tuple, batch.collect()))
    assert sorted(tuple(r) for r in step.alerts(spark).select(*batch.columns).collect()) == want
    assert {w[1] for w in want} == {"day", "hour", "minute", "second"}
    brute = set()
    for agent, tool, t in rows:
        limit, unit = dict(day=(12, 86_400), hour=(5, 3600), minute=(2, 60), second=(1, 1)).get(tool, (10**9, 0))
        if sum(a == agent and b == tool and t - unit <= u <= t for a, b, u in rows) > limit:
            brute.add((agent, tool, t))
    assert {tuple(r) for r in batch.select("agent", "tool", F.unix_seconds("ts")).collect()} == brute


def test_unknown_rate_unit_fails(spark):
    registry = spark.createDataFrame([("x", "1/week")], "tool string, rate_limit string")
    calls = spark.createDataFrame([("a", "x", 1)], "agent string, tool string, ts long").withColumn("ts", F.timestamp_seconds("ts"))
    with pytest.raises(Exception, match="unknown rate limit unit"):
        agents.over_rate_limit(calls, registry).collect()


def test_own_ttl_of_each_message(spark, tmp_path):
    rnd = random.Random(5)
    rows, at = [], {}
    for i in range(600):
        trace = rnd.choice([1, 1, 1, 2, 3])
        seq = sum(r[0] == trace for r in rows)
        at[trace] = at.get(trace, 10_000) + rnd.choice([5, 61, 500, 7100, 7300])
        rows.append((trace, seq, at[trace], rnd.choice([60, 60, 7200, None])))
    schema = "trace_id long, seq long, created_at long, ttl_seconds long"
    step = sinks.MessageTtl(str(tmp_path), DELAY)
    order = shuffled(rows, 2, 6)
    feed(spark, step, order, schema, [50, 300, 301], "created_at")
    table = spark.createDataFrame(rows, schema).withColumn("created_at", F.timestamp_seconds("created_at"))
    newest = max(r[2] for r in rows)
    seen = agents.expired(table, F.timestamp_seconds(F.lit(newest - DELAY)))
    want = sorted((r["trace_id"], r["seq"]) for r in seen.collect())
    assert sorted((r["trace_id"], r["seq"]) for r in step.alerts(spark).select("trace_id", "seq").collect()) == want
    step.finish(spark)
    ever = agents.expired(table, F.timestamp_seconds(F.lit(10**9)))
    got = sorted((r["trace_id"], r["seq"]) for r in step.alerts(spark).select("trace_id", "seq").collect())
    assert got == sorted((r["trace_id"], r["seq"]) for r in ever.collect()) and len(got) > len(want)


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    step = sinks.MessageTtl(str(tmp_path), DELAY)
    schema = "trace_id long, seq long, created_at long, ttl_seconds long"
    feed(spark, step, [(1, 0, 10_000, 60), (1, 1, 20_000, 60), (2, 0, 19_399, 60), (2, 1, 19_401, 60), (3, 0, None, 60)], schema, [2], "created_at")
    assert late_rows(spark, str(tmp_path)) == 1
    step.finish(spark)
    assert sorted((r["trace_id"], r["seq"]) for r in step.alerts(spark).collect()) == [(1, 0), (1, 1), (2, 1)]


def test_an_empty_stream(spark, tmp_path):
    step = sinks.RateLimit(str(tmp_path), dims.dim(spark, "tool_registry"))
    feed(spark, step, [], "agent string, tool string, ts long", [], "ts")
    step.finish(spark)
    assert step.alerts(spark).count() == 0


# token map ------------------------------------------------------------------------------------------------------------


def replay(puts):
    """Accepted puts of one token after another."""
    out, ends = [], {}
    for token, value, session, at, end in sorted(puts, key=lambda p: (p[0], p[3], p[2], p[1])):
        if token not in ends or at >= ends[token]:
            ends[token] = end
            out.append((token, value, at))
    return sorted(out)


def put_table(spark, puts):
    df = spark.createDataFrame(puts, "token string, value string, session_id string, a long, b long")
    return df.select("token", "value", F.lit("EMAIL").alias("type"), "session_id", F.timestamp_seconds("a").alias("created_at"), F.timestamp_seconds("b").alias("expires_at"))


def accepted(df):
    return sorted((r["token"], r["value"], r["a"]) for r in df.withColumn("a", F.unix_seconds("created_at")).collect())


def test_re_issues_equal_a_replay(spark):
    rnd = random.Random(7)
    puts = []
    for i in range(4000):
        at = rnd.randrange(20_000)
        puts.append((rnd.choice(["hot", "hot", "hot", f"t{rnd.randrange(300)}"]), f"v{rnd.randrange(50)}", f"s{rnd.randrange(3)}", at, at + rnd.choice([1, 60, 60, 900, 5000])))
    puts += [("none", "v", "s", 5, 5), ("none", "w", "s", 6, 6)]  # without a life
    assert accepted(tokens.write_once(None, put_table(spark, puts))) == replay(puts)


def test_many_re_issues_take_few_rounds(spark, monkeypatch):
    n = 5000
    rounds = []
    monkeypatch.setattr(tokens, "pinned", lambda df, own=tokens.pinned: rounds.append(1) or own(df))
    puts = [("hot", f"v{i}", "s", i * 3600, (i + 1) * 3600) for i in range(n)] + [("hot", "no", "s", i * 3600 + 5, i * 3600 + 3605) for i in range(0, n, 10)]
    got = tokens.write_once(None, put_table(spark, puts))
    assert len(rounds) <= 17  # the instants, the numbered nodes, and the logarithm of the path
    assert got.count() == n and got.where("value = 'no'").count() == 0


def test_stream_keeps_tokens_of_a_longer_life(spark, tmp_path):
    step = sinks.append_token_map(str(tmp_path))
    day = 86_400
    for epoch, put in enumerate([("t", "first", "s", 0, 7 * day), ("t", "second", "s", 4 * day, 4 * day + 3600), ("t", "third", "s", 7 * day, 7 * day + 60)]):
        step(put_table(spark, [put]), epoch)
    assert {r["value"] for r in spark.read.parquet(f"{tmp_path}/map").collect()} == {"first", "third"}
