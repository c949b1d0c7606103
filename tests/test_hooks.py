"""A test model per hook; failures are counted, not lost."""

import re

import pytest
from pyspark.sql import functions as F

from custodia.operators import hooks, quality, redaction


def names(texts):
    if any("crash" in t for t in texts):
        raise RuntimeError("no batch with this text")
    return [[(m.start(), m.end() + (100 if "outside" in t else 0), "PERSON", 0.9) for m in re.finditer(r"\bAda\b", t)] for t in texts]


def test_recogniser_joins_the_overlap_rule(spark):
    rows = [(1, "Ada wrote to ada@x.org"), (2, "nothing"), (3, None), (4, "crash Ada"), (5, "outside Ada"), (6, "mail Ada@x.org Ada"), (7, "")]
    docs = spark.createDataFrame(rows, "id int, t string")
    done = hooks.recognise(docs, "t", names, max_texts=3)
    got = {r["id"]: [(e["type"], e["value"]) for e in r["entities"]] for r in redaction.detect(done, "t", "id", extra=F.col("extra")).collect()}
    assert got == {1: [("PERSON", "Ada"), ("EMAIL", "ada@x.org")], 2: [], 3: [], 4: [], 5: [], 6: [("EMAIL", "Ada@x.org"), ("PERSON", "Ada")], 7: []}
    assert {r["error"]: r["n"] for r in hooks.failures(done).collect()} == {"none": 5, "RuntimeError": 1, "ValueError": 1}


def test_embedder_feeds_the_cosine(spark):
    def model(texts):
        return [[1.0, float(len(t)), 0.0][: 2 if t == "short" else 3] for t in texts]

    rows = [("p", "a"), ("p", "a"), ("q", "bb"), ("q", "bb"), ("q", "short")]
    done = hooks.embed(spark.createDataFrame(rows, "prompt string, t string"), "t", model, 3)
    scores = {r["prompt"]: (r["n"], r["score"]) for r in quality.self_consistency(done.where("error IS NULL"), "prompt", "embedding").collect()}
    assert scores == {"p": (2, pytest.approx(1)), "q": (2, pytest.approx(1))}
    assert done.where("error IS NOT NULL").count() == 1


def test_judge_feeds_the_averages(spark):
    def model(texts):
        return [None if t == "x" else '{"factual_accuracy": 4, "completeness": 2, "hallucination": 1, "instruction_following": 5}' for t in texts]

    done = hooks.judge(spark.createDataFrame([("m", "a"), ("m", "b"), ("m", "x")], "model string, t string"), "t", model)
    row = quality.judge_averages(done.where("error IS NULL"), "model", "judge_json").first()
    assert 4.0 in [v for v in row if isinstance(v, float)] and {r["error"] for r in hooks.failures(done).collect()} == {"none", "TypeError"}


def test_calls_are_bounded():
    texts = ["a" * 400, None, "b" * 700, "c" * 5000, "", "d"] + ["e"] * 10
    chunks = list(hooks._chunks(texts, 4, 1000))
    assert sorted(i for c in chunks for i in c) == [i for i, t in enumerate(texts) if t is not None]
    assert all(len(c) <= 4 and (len(c) == 1 or sum(len(texts[i]) for i in c) <= 1000) for c in chunks)


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([], "error string, t string")
    with pytest.raises(ValueError):
        hooks.judge(df, "t", len)
    assert hooks.judge(df.select("t"), "t", len).count() == 0
