"""Cases that gates, pages, snapshots and evidence must not let through."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from custodia.functions import text as tx
from custodia.operators import access, audit, golden, governance
from custodia.sources import dims


def test_a_missing_answer_fails_every_gate(spark):
    gold = spark.createDataFrame([(i, ["a", "b"], 3) for i in range(4)], "item_id int, required_facts array<string>, min_score int")
    runs = spark.createDataFrame([(0, "a b", 5), (1, None, 5), (2, "a b", None), (3, "a", 5)], "item_id int, response string, score int")
    done = golden.evaluate(runs, gold)
    assert [(r["facts_ok"], r["passed"]) for r in done.orderBy("item_id").collect()] == [(True, True), (False, False), (True, False), (False, False)]
    assert golden.smoke(done, 1).first()["passed"] and not golden.smoke(done, 2).first()["passed"]
    assert tuple(golden.smoke(done.limit(0)).first()) == (0, False)


def test_unknown_paths_are_refused(spark):
    paths = ["/v1/audit", "/v1/audit/", "/v1/other", "/health", None]
    log = spark.createDataFrame([(p, "Bearer x", r) for p in paths for r in ("VIEWER", "SUPER_ADMIN", "NOBODY")], "path string, auth string, role string")
    got = {(r["path"], r["role"]): r["status"] for r in access.decide(log, dims.dim(spark, "route_roles"), "path", "auth", F.lit(True), "role").collect()}
    assert [got[p, "SUPER_ADMIN"] for p in paths] == [200, 404, 404, 200, 403]
    assert [got[p, "VIEWER"] for p in paths] == [403, 404, 404, 200, 403] and got["/v1/other", "NOBODY"] == 403


def test_pages_over_equal_times_lose_no_row(spark):
    log = spark.createDataFrame([(f"e{i}", 1 if i < 6 else 2) for i in range(8)], "event_id string, ts int")
    seen, after = [], None
    while rows := audit.page(log, "SUPER_ADMIN", ["ts"], limit=2, after=after).collect():
        seen += [r["event_id"] for r in rows]
        after = (rows[-1]["ts"], rows[-1]["event_id"])
    assert seen == ["e7", "e6", "e5", "e4", "e3", "e2", "e1", "e0"]
    with pytest.raises(ValueError):
        audit.page(log, "SUPER_ADMIN", ["ts"], after=(1,))


def snapshot(spark, change=lambda rows: rows):
    rows = [(f"e{i}", 86_400 * (i % 3) + i, None if i % 7 == 0 else f"u{i % 5}", i) for i in range(5000)]
    df = spark.createDataFrame(change(rows + rows[:50]), "event_id string, ts long, user_id string, latency_ms int")
    return df.withColumn("ts", F.timestamp_seconds("ts"))


@pytest.mark.parametrize(
    "change, n",
    [
        (lambda rows: rows, 0),
        (lambda rows: rows[::-1], 0),
        (lambda rows: [("e9", *rows[9][1:3], 77) if r[0] == "e9" else r for r in rows], 2),
        (lambda rows: rows[1:], 1),  # one of two equal rows
        (lambda rows: [r for r in rows if r[0] != "e4000"] + [("new", 5, None, 1)], 1),
        (lambda rows: [(r[0], r[1], "" if r[2] is None and r[0] == "e4998" else r[2], r[3]) for r in rows], 1),
        (lambda rows: [(r[0], r[1], "" if r[0] == "e4991" else r[2], r[3]) for r in rows], 1),  # null is not empty
    ],
)
def test_digests_find_what_a_full_comparison_finds(spark, change, n):
    old, new = snapshot(spark), snapshot(spark, change)
    got = audit.altered_rows(old, new)
    assert got.count() == n and sorted(map(str, got.collect())) == sorted(map(str, old.exceptAll(new).collect()))
    kept = audit.digests(old)  # as stored beside the snapshot
    assert audit.altered_rows(old, new, old_digests=kept).count() == n


def test_one_changed_row_leads_to_one_cell(spark):
    old = snapshot(spark)
    new = snapshot(spark, lambda rows: [("e4000", *rows[4000][1:3], -1) if r[0] == "e4000" else r for r in rows])
    cells = audit.differing(audit.digests(old), audit.digests(new))
    assert cells.count() == 1 and audit.suspects(old, cells).count() < 40
    a, b = ({r["day"]: r["root"] for r in audit.roots(audit.digests(x)).collect()} for x in (old, new))
    assert sum(a[d] != b[d] for d in a) == 1 and len(a) == 3


def test_evidence_of_runs(spark):
    lines = [
        (1, "tests/validation/x.py::test_PROMPT_injection PASSED"), (1, "test_audit FAILED"), (2, "test_latency SKIPPED"), (2, "other Passed"), (3, None), (3, "fake_token failed"),
    ]
    runs = spark.createDataFrame([(1, "pytest", 1), (2, "pytest", 0), (3, "pytest", None), (4, "pytest", 0)], "run_id int, command string, exit_code int")
    table = spark.createDataFrame(lines, "run_id int, line string")
    words, controls = dims.dim(spark, "control_keywords"), dims.dim(spark, "controls")
    rows = governance.run_controls(runs, governance.evidence_checks(table, words), controls)
    got = {(r["run_id"], r["control_id"]): r["status"] for r in rows.collect()}
    assert [got[1, c] for c in ("G1", "G2", "G3", "RT1")] == ["PASS", "FAIL", "PASS", "FAIL"]  # all words of G3 occur, on two lines
    assert [got[2, c] for c in ("G4", "G3")] == ["PASS", "SKIPPED"] and got[3, "RT2"] == "FAIL" and got[4, "G1"] == "SKIPPED"
    assert {r["evidence"] for r in rows.collect()} == {"pytest (exit=1)", "pytest (exit=0)", "pytest (exit=unknown)"}
    strict = governance.run_controls(runs, governance.evidence_checks(table, words, same_line=True), controls)
    got = {(r["run_id"], r["control_id"]): (r["status"], r["detail"]) for r in strict.collect()}
    assert got[1, "G1"] == ("PASS", lines[0][1]) and got[1, "G3"] == ("FAIL", None) and got[2, "G4"] == ("SKIPPED", None)


def test_all_keywords(spark):
    df = spark.createDataFrame([("Ab cd", ["AB", "CD"]), ("ab", ["ab", "cd"]), ("x", []), (None, ["a"])], "t string, k array<string>")
    assert [r[0] for r in df.select(tx.all_keywords(F.col("t"), F.col("k"))).collect()] == [True, False, True, False]


def test_entry_without_a_module_of_the_optional_part():
    code = "import sys; sys.modules['tiktoken'] = None; sys.modules['custodia.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 140 and 'pipeline' not in e.queries()"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0])
    assert done.returncode == 0, done.stderr[-500:]
