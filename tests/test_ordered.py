"""Hot groups against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from custodia.operators import latency, percentiles
from custodia.operators.ordered import ordered_window, trailing_count
from custodia.operators.percentiles import exact_percentiles


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    out = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}"
        out.append((key, rnd.randrange(400), i, rnd.randrange(50) if rnd.random() < 0.9 else None))
    return out


def test_running_lag_lead(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, id int, x int")
    got = ordered_window(
        df, ["k"], ["t", "id"],
        running={"s": ("sum", F.col("x")), "m": ("max", F.col("x"))},
        lag={"p": F.col("x")}, lead={"q": F.col("x")},
    )
    want = {}
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_key.setdefault(r[0], []).append(r)
    for group in by_key.values():
        s = m = None
        for j, r in enumerate(group):
            if r[3] is not None:
                s = (s or 0) + r[3]
                m = r[3] if m is None else max(m, r[3])
            want[r[2]] = (s, m, group[j - 1][3] if j else None, group[j + 1][3] if j + 1 < len(group) else None)
    assert {r["id"]: (r["s"], r["m"], r["p"], r["q"]) for r in got.collect()} == want


def test_global_order(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, id int, x int")
    got = ordered_window(df, [], ["t", "id"], running={"n": ("sum", F.lit(1))})
    order = sorted((r[1], r[2]) for r in rows)
    assert {(r["t"], r["id"]): r["n"] for r in got.collect()} == {o: i + 1 for i, o in enumerate(order)}


def test_trailing_count(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, id int, x int").select("k", F.timestamp_seconds("t").alias("ts"))
    got = trailing_count(df, ["k"], "ts", "60 SECONDS")
    got = {(r["k"], int(r["ts"].timestamp())): (r["n"], r["n_trailing"]) for r in got.collect()}
    base = min(t for _, t in got) - min(r[1] for r in rows)
    want = {
        (k, t + base): (sum(r[0] == k and r[1] == t for r in rows), sum(r[0] == k and t - 60 <= r[1] <= t for r in rows))
        for k, t in {(r[0], r[1]) for r in rows}
    }
    assert got == want


@pytest.mark.parametrize("how", ["linear", "index"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles(spark, rows, how, keys, monkeypatch):
    # coarse cells, so that a cell holds many values at this size
    monkeypatch.setattr(percentiles, "CELLS", 2)
    df = spark.createDataFrame([(r[0], float(r[1]) / 7) for r in rows], "k string, v double")
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    plain = exact_percentiles(df, keys, "v", probs, how).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r[0],) if keys else (), []).append(r[1] / 7)
    for row in plain:
        vals = sorted(groups[tuple(row[k] for k in keys)])
        assert row["n"] == len(vals)
        for name, p in probs.items():
            if how == "index":
                assert row[name] == vals[int(len(vals) * p)]
            else:
                pos = p * (len(vals) - 1)
                lo, hi = vals[int(pos)], vals[min(int(pos) + 1, len(vals) - 1)]
                assert row[name] == pytest.approx(lo + (hi - lo) * (pos - int(pos)))


def test_index_percentile_rejects_one(spark):
    with pytest.raises(ValueError):
        exact_percentiles(spark.range(3).selectExpr("cast(id as double) v"), [], "v", {"p": 1.0}, "index")


def test_percentiles_of_null_keys(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "CELLS", 2)
    rows = [("a", float(i)) for i in range(10)] + [(None, float(i)) for i in range(5)] + [("hot", float(i % 977)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["n"], r["p50"]) for r in exact_percentiles(df, ["k"], "v", {"p50": 0.5}).collect()}
    assert got == {"a": (10, 4.5), None: (5, 2.0), "hot": (20_000, 476.5)}
    summary = {r["k"]: (r["n"], r["median"], r["mean"]) for r in latency.summary(df, "v", ["k"]).collect()}
    assert summary[None] == (5, 2.0, 2.0) and len(summary) == 3


def test_null_keys_and_one_key_with_almost_all_rows(spark):
    rows = [("hot" if i % 100 else None, i) for i in range(5000)]
    got = ordered_window(spark.createDataFrame(rows, "k string, t int"), ["k"], ["t"], running={"n": ("sum", F.lit(1))}, lag={"p": F.col("t")})
    seen, want = {}, {}
    for k, t in rows:
        n, p = seen.get(k, (0, None))
        want[t] = (n + 1, p)
        seen[k] = (n + 1, t)
    assert {r["t"]: (r["n"], r["p"]) for r in got.collect()} == want


def test_percentiles_of_any_values(spark):
    """Below zero, around it, tiny, huge and infinite ones, repeated ones; NaN counts as the largest."""
    rnd = random.Random(8)
    values = [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-12, 12) for _ in range(900)] + [0.0] * 50 + [5.0] * 100 + [float("inf")] * 3 + [float("-inf")] * 2
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    probs = {f"p{i}": i / 20 for i in range(20)}
    (row,) = exact_percentiles(df, [], "v", probs, "index").collect()
    assert row["n"] == len(values) and [row[n] for n in probs] == [sorted(values)[int(len(values) * p)] for p in probs.values()]
    (row,) = exact_percentiles(spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "v double"), [], "v", {"a": 0.0, "b": 0.5, "c": 1.0}).collect()
    assert (row["a"], row["b"]) == (1.0, 2.0) and row["c"] != row["c"]
    assert exact_percentiles(df.limit(0), [], "v", probs).count() == 0
