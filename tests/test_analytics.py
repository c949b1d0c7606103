"""Evaluation, agents and governance on small tables with known answers."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from custodia.functions import sampling, text as tx
from custodia.operators import agents, golden, governance, grounding, latency, quality
from custodia.sources import dims, readers


def test_consistency_equals_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(i % 4, i, [rnd.gauss(0, 1) for _ in range(5)]) for i in range(17)] + [(9, 99, [1.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "g int, id int, e array<float>")
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.dist(a, [0] * 5) / math.dist(b, [0] * 5)
    want = {}
    for g in {r[0] for r in rows}:
        pairs = [cos(a[2], b[2]) for a, b in itertools.combinations([r for r in rows if r[0] == g], 2)]
        want[g] = sum(pairs) / len(pairs) if pairs else None
    got = {r["g"]: r["score"] for r in quality.self_consistency(df, "g", "e").collect()}
    assert got.keys() == want.keys() and got[9] is None
    for g, w in want.items():
        assert w is None or got[g] == pytest.approx(w, abs=1e-6)
    per = {r["id"]: r["mean_similarity"] for r in quality.similarity_to_others(df, "g", "id", "e").collect()}
    for r in rows:
        others = [cos(r[2], o[2]) for o in rows if o[0] == r[0] and o[1] != r[1]]
        assert (per[r[1]] is None) == (not others)
        if others:
            assert per[r[1]] == pytest.approx(sum(others) / len(others), abs=1e-6)


def test_grounding_equals_brute_force(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(12)]
    sent = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    chunks = [(i % 3, i, sent(rnd.randrange(2, 40))) for i in range(30)]
    claims = [(rnd.randrange(3), i, sent(rnd.randrange(1, 9))) for i in range(300)]
    for i, (scope, cid, t) in enumerate(list(chunks)):  # some true quotes
        words = t.split()
        claims.append((scope, 1000 + i, " ".join(words[3:12]) or t))
    def sh(t):
        w = t.split()
        return {" ".join(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {" ".join(w)}
    for scope in ([], ["scope"]):
        cl = spark.createDataFrame(claims, "scope int, id int, claim string")
        ch = spark.createDataFrame(chunks, "scope int, chunk_id int, chunk string")
        got = {r["id"]: r["supported"] for r in grounding.ground(cl, ch, scope=scope).collect()}
        want = {
            c[1]: any(10 * len(sh(c[2]) & sh(k[2])) >= 6 * len(sh(c[2])) for k in chunks if not scope or k[0] == c[0]) for c in claims
        }
        assert got == want and 0 < sum(want.values()) < len(want)


def test_sentences(spark):
    df = spark.createDataFrame([("One. Two!  Three?? four\nfive . ... ",)], "t string")
    assert df.select(tx.sentences(F.col("t"))).first()[0] == ["One.", "Two!", "Three??", "four five ."]


def test_low_runs_need_more_than_bound(spark):
    scores = [0.6] * 20 + [0.9] + [0.5] * 21 + [None] + [0.1]
    df = spark.createDataFrame([("m", i, i, s) for i, s in enumerate(scores)], "m string, t int, id int, s double")
    got = [(r["run_length"], r["started"], r["ended"]) for r in quality.low_runs(df, "m", "s", ["t", "id"]).collect()]
    assert got == [(21, 21, 41)]


def test_low_run_stream_over_batches(spark, tmp_path):
    from custodia.streaming.sinks import low_run_alerts

    step = low_run_alerts(str(tmp_path), "m", "s", ["ts", "id"], longer_than=4)
    batches = [
        {"a": [0.1, 0.1], "b": [0.1, 0.9, 0.1]}, {"a": [0.1, 0.1]}, {"a": [0.1], "b": [0.1, 0.1, 0.1, 0.1, 0.1]},
        {"a": [0.1, 0.9, 0.1, 0.1, 0.1, 0.1, 0.1]}, {"b": [0.9], "a": [0.1]},
    ]
    n = itertools.count()
    alerts, flat = [], {}
    for epoch, batch in enumerate(batches):
        rows = [(k, next(n), s) for k, ss in batch.items() for s in ss]
        for k, i, s in rows:
            flat.setdefault(k, []).append(s)
        df = spark.createDataFrame(rows, "m string, id int, s double").withColumn("ts", F.timestamp_seconds("id"))
        step(df, epoch)
        step(df, epoch)  # a repeated batch overwrites its own output
        alerts += [(r["m"], r["run_length"]) for r in spark.read.parquet(f"{tmp_path}/alerts/epoch={epoch}").collect()]
    # a: five low in batches 0-2, then five more after the break; b: run of six from its last low of batch 0
    assert sorted(alerts) == [("a", 5), ("a", 5), ("b", 6)]


def test_sampling_share(spark):
    n = spark.range(20_000).where(sampling.in_share(F.col("id"), 0.1)).count()
    assert 1800 < n < 2200


def test_ttft_regression(spark):
    rows = [("m", d, 100.0 if d != 9 else 151.0) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "model_id string, d int, ttft_ms double").withColumn("ts", F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("d"), F.lit(5), F.lit(0), F.lit(0)))
    got = latency.ttft_regressions(df).collect()
    assert [(r["day"].day, r["p95"], r["baseline"]) for r in got] == [(9, 151.0, 100.0)]


def test_control_report(spark):
    controls = dims.dim(spark, "controls")
    checks = spark.createDataFrame([("G1", "a", False), ("G1", "b", True), ("G2", "a", True), ("G3", "a", False)], "control_id string, evidence_group string, passed boolean")
    status = governance.control_status(checks, controls)
    assert [r["status"] for r in status.orderBy("ord").collect()] == ["PASS", "PASS", "FAIL", "FAIL", "FAIL", "FAIL"]
    one = governance.overall(status).first()
    assert (one["overall_status"], one["note"]) == ("REVIEW_REQUIRED", "Failing controls: G3, G4, RT1, RT2")
    good = spark.createDataFrame([("G1", "a", True)], "control_id string, evidence_group string, passed boolean")
    assert {r["status"] for r in governance.control_status(good, controls).collect()} == {"PASS", "SKIPPED"}
    every = spark.createDataFrame([(c, "a", True) for c in ("G1", "G2", "G3", "G4", "RT1", "RT2")], "control_id string, evidence_group string, passed boolean")
    assert governance.overall(governance.control_status(every, controls)).first()["overall_status"] == "APPROVED"


def test_rollback_target(spark):
    v = spark.createDataFrame(
        [("q", "v1.0", 0.95, "2025-01-01"), ("q", "v1.1", 0.88, "2025-03-10"), ("q", "v1.2", 0.70, "2025-04-01"), ("q", "v1.3", 0.91, "2025-04-15"), ("g", "x", 0.94, "2025-04-01")],
        "model_id string, version string, eval_score double, deployed string",
    )
    got = {r["model_id"]: (r["current_version"], r["target_version"]) for r in governance.rollback_target(v, 0.85).collect()}
    assert got == {"q": ("v1.3", "v1.1"), "g": ("x", None)}


def test_required_params_and_limits(spark):
    reg = dims.dim(spark, "tool_registry")
    calls = spark.createDataFrame([(1, "jira_search", '{"jql_query": "x"}'), (2, "jira_search", "{}"), (3, "jira_search", "junk"), (4, "nope", "{}"), (5, "slack_send_dm", '{"text": "a"}')], "call_id int, tool string, p string")
    got = {r["call_id"]: r["missing"] for r in agents.missing_params(calls, reg, "p").collect()}
    assert got == {2: ["jql_query"], 3: ["jql_query"], 5: ["user_id"]}
    assert {r["tool"]: r["per_window"] for r in agents.rate_limits(reg).collect()}["slack_send_dm"] == 10


def test_rate_limit_at_exact_bound(spark):
    reg = dims.dim(spark, "tool_registry")
    rows = [("ESCALATION", "slack_send_dm", s, i) for i, s in enumerate(list(range(0, 600, 60)) + [3600, 3601])]
    calls = spark.createDataFrame(rows, "agent string, tool string, s int, call_id int").withColumn("ts", F.timestamp_seconds("s"))
    # 10 allowed: the 11th call, exactly one hour after the first, is over; one second later the first has left
    got = [r["n_trailing"] for r in agents.over_rate_limit(calls, reg).orderBy("ts").collect()]
    assert got == [11, 11]


def test_limits_of_other_units(spark):
    reg = spark.createDataFrame([("t", ["A"], "2/minute"), ("u", ["A"], "3/fortnight")], "tool string, allowed_agents array<string>, rate_limit string")
    calls = spark.createDataFrame([("A", "t", s, s) for s in range(0, 100, 10)], "agent string, tool string, s int, call_id int").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted(r["n_trailing"] for r in agents.over_rate_limit(calls, reg.where("tool = 't'")).collect())
    assert got == [3, 4, 5, 6, 7, 7, 7, 7]
    with pytest.raises(Exception, match="unknown rate limit unit"):
        agents.over_rate_limit(calls, reg).collect()


def test_agents_without_trust_are_not_trusted(spark):
    trust = spark.createDataFrame([("A", 3, True)], "agent string, level int, can_write boolean")
    messages = spark.createDataFrame([("x", 1, "A", "B", "execute"), ("x", 2, "new", "B", "execute")], "trace_id string, seq int, sender string, recipient string, message_type string")
    calls = spark.createDataFrame([(1, "A", "w"), (2, "new", "w"), (3, "new", "a_search")], "call_id int, agent string, tool string")
    assert {(r["kind"], r["item"]) for r in agents.trust_violations(messages, calls, trust).collect()} == {("message", "x:2"), ("tool", "2")}


def test_expiry(spark):
    df = spark.createDataFrame([("t", 0, 0), ("t", 1, 300), ("t", 2, 601)], "trace_id string, seq int, s int").withColumns(
        {"created_at": F.timestamp_seconds("s"), "ttl_seconds": F.lit(300)})
    for as_of, want in ((902, {(1, True), (2, False)}), (901, {(1, True)}), (601, {(1, True)}), (600, set())):
        got = {(r["seq"], r["answered_late"]) for r in agents.expired(df, F.timestamp_seconds(F.lit(as_of))).collect()}
        assert got == want


def test_golden_json(spark, tmp_path):
    (tmp_path / "g.json").write_text(
        '{"id": "gs_001", "task_type": "rag_query", "prompt": "p", "context_chunks": ["c"], "reference_answer": "r", '
        '"acceptable_range": {"min_score": 4, "required_facts": ["14.3%", "APAC", "Q3"]}, "tags": ["finance"]}\n')
    gold = readers.golden_set(spark, str(tmp_path))
    runs = spark.createDataFrame([("gs_001", "a", 4, "APAC grew 14.3% in Q3"), ("gs_001", "b", 3, "APAC grew 14.3% in Q3"), ("gs_001", "c", 5, "APAC grew")], "item_id string, model_id string, score int, response string")
    got = {r["model_id"]: r["passed"] for r in golden.evaluate(runs, gold).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_judge_parsing(spark):
    df = spark.createDataFrame([("m", '{"factual_accuracy": 4, "completeness": 2, "hallucination": 1, "instruction_following": 5, "notes": ""}'), ("m", "not json")], "m string, j string")
    odd = [("m", '{"factual_accuracy": 99, "completeness": 2, "hallucination": 1, "instruction_following": 5}'), ("m", '{"factual_accuracy": 3}')]
    assert quality.judge_averages(df.union(spark.createDataFrame(odd, "m string, j string")), "m", "j").first()["malformed"] == 3
    r = quality.judge_averages(df, "m", "j").first()
    assert (r["n"], r["malformed"], r["factual_accuracy"], r["completeness"]) == (2, 1, 4.0, 2.0)
    assert df.select(quality.is_json(F.col("j"), ["completeness"]), quality.is_json(F.col("j"), ["other"])).collect() == [(True, False), (False, False)]
    assert [x[0] for x in df.select(quality.is_json_object(F.col("j"))).collect()] == [True, False]


def test_bundle_lists_are_whole_and_bounded(spark):
    items = spark.range(1234).select(F.lit(7).alias("trace_id"), F.lit("jira").alias("section"), F.col("id").alias("item"))
    lists = agents.bundle_lists(items, per_list=500).orderBy("part").collect()
    assert [len(r["items"]) for r in lists] == [500, 500, 234]
    assert sum((r["items"] for r in lists), []) == list(range(1234))
