"""The inverted index against a scan of all texts."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from custodia.operators import search

ITEM = ["a", "b"]


def items(n=300):
    rnd = random.Random(9)
    words = ["the"] * 40 + [f"w{i}" for i in range(60)] + ["Rare,", "THE.", "w1;"]
    return [(i % 7, i, rnd.choice(["x", "y", None]), rnd.choice([None, ""]) if i % 50 == 0 else " ".join(rnd.choices(words, k=rnd.randrange(1, 40))), 1_700_000_000 + 3600 * (i % 90)) for i in range(n)]


def build(spark, path, rows):
    df = spark.createDataFrame(rows, "a int, b int, author string, text string, ts long").withColumn("ts", F.timestamp_seconds("ts"))
    search.append(df, path, ITEM, "text", "author", "ts", parts=16)


def plain(rows, terms, author=None, since=None, half=None, as_of=None):
    cut = [(r, re.findall(r"[^\s.,;:!?]+", (r[3] or "").lower())) for r in rows]
    average = sum(len(w) for _, w in cut) / len(cut)
    out = []
    for r, w in cut:
        score = 0.0
        for t in {t.lower() for t in terms}:
            df, tf = sum(t in x for _, x in cut), w.count(t)
            if tf:
                score += math.log(1 + (len(cut) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / average))
        if score and (author is None or r[2] == author) and (since is None or r[4] >= since):
            out.append((score * (0.5 ** ((as_of - r[4]) / 86400 / half) if half else 1), r[4], r[0], r[1]))
    return sorted(out, key=lambda x: (-x[0], -x[1], x[2], x[3]))


def test_equal_to_a_full_scan_after_appends(spark, tmp_path):
    rows, path = items(), str(tmp_path)
    build(spark, path, rows[:100])
    build(spark, path, rows[100:])
    for terms, options in [(["the", "rare"], {}), (["THE"], {"author": "x"}), (["w1", "w2", "none"], {"since": 1_700_100_000}), (["the", "w3"], {"half": 2.0, "as_of": 1_700_400_000}), (["none"], {})]:
        spark_options = {"author": options.get("author"), "half_life_days": options.get("half")}
        if "since" in options:
            spark_options["since"] = F.timestamp_seconds(F.lit(options["since"]))
        if "as_of" in options:
            spark_options["as_of"] = F.timestamp_seconds(F.lit(options["as_of"]))
        got = search.search(spark, path, ITEM, terms, 40, parts=16, **spark_options).collect()
        want = plain(rows, terms, **options)[:40]
        assert [r["score"] for r in got] == pytest.approx([w[0] for w in want])
        assert [(r["a"], r["b"]) for r in got if r["score"] > 1e-9] == [w[2:] for w in want]


def test_other_terms_are_not_read(spark, tmp_path):
    path = str(tmp_path)
    build(spark, path, items())
    every = len(set(spark.read.parquet(f"{path}/postings").inputFiles()))
    plan = search.hits(spark, path, ["rare"], parts=16)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PushedFilters: [" in plan and "EqualTo(term,rare)" in plan
    assert every >= 8 and len({r[0] for r in search.hits(spark, path, ["rare"], parts=16).select("part").distinct().collect()}) == 1


def test_no_index_and_no_term(spark, tmp_path):
    with pytest.raises(ValueError):
        search.search(spark, str(tmp_path), ITEM, ["x"], 3)
    with pytest.raises(ValueError):
        search.search(spark, str(tmp_path), ITEM, [], 3)


def test_a_shingle_in_all_chunks_is_cut_into_blocks(spark, monkeypatch):
    from custodia.operators import grounding

    monkeypatch.setattr(grounding, "BLOCK", 50)
    rnd = random.Random(10)
    chunks = [(i, f"once upon a time {' '.join(rnd.choices('abcdefgh', k=rnd.randrange(0, 9)))}") for i in range(1200)]
    claims = [(i, f"once upon a time {' '.join(rnd.choices('abcdefgh', k=rnd.randrange(0, 5)))}") for i in range(60)] + [(90, "nothing alike here"), (91, "once upon a")]
    ch = spark.createDataFrame(chunks, "chunk_id int, chunk string")
    cl = spark.createDataFrame(claims, "id int, claim string")

    def sh(t):
        w = t.split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)}

    held = [sh(c) for _, c in chunks]
    want = {i: any(10 * len(sh(t) & c) >= 6 * len(sh(t)) for c in held) for i, t in claims}
    assert {r["id"]: r["supported"] for r in grounding.ground(cl, ch).collect()} == want and len(set(want.values())) == 2
    right = grounding._shingled(ch.select(F.col("chunk").alias("__t")).distinct().withColumn("__chunk", F.sha2("__t", 256)), ["__chunk"], "__t", 3)
    postings = right.select("__chunk", F.size("sh").alias("held"), F.explode("sh").alias("s"))
    freq = postings.groupBy("s").agg(F.count("*").alias("df"))
    sizes = grounding._blocked(postings, freq, []).groupBy("s", "block").count()
    assert freq.agg(F.max("df")).first()[0] > 800 and sizes.agg(F.max("count")).first()[0] < 100
