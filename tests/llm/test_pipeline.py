"""The whole pipeline on a corpus whose right answer is known."""

import gc
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from custodia.llm.common import stored
from custodia.llm.queries import ORACLES, QUERIES, TOKENIZER
from tests.llm.test_text_operators import reference
from tests.oracle_compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(29)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "ren", "tol", "mi")]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, text(25)) for i in range(5)]
    docs, labels, clean = [], [], []
    for i in range(700):
        kind = "toxic" if i % 8 == 0 else "junk" if i % 8 == 1 else "leak" if i % 60 == 2 else "copy" if i % 20 == 7 and clean else "clean"
        body = text(rng.randint(60, 120))
        if kind == "toxic":
            body = f"{body} you idiot {text(5)} moron"
        if kind == "junk":
            body = " ".join(f"{w}###" for w in body.split())
        if kind == "leak":
            body = f"{body} {rng.choice(items)[1].upper()}. {text(20)}"
        if kind == "copy":
            body = docs[rng.choice(clean)][1] + " ren"
        if kind == "clean":
            clean.append(i)
        docs.append((i, body, "en", "src", len(body)))
        if i % 10 < 7:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    docs += [docs[clean[0]], (None, text(80), None, None, None)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), {d[0]: d[1] for d in docs}, clean


def test_clean_documents_stay_and_nothing_else(spark, corpus):
    path, texts, clean = corpus
    got = corpus_pipeline.run(spark, path).collect()
    full = reference()
    kept = sorted(r.doc_id for r in got if r.doc_id is not None)
    assert (sorted(set(kept) - set(clean)), sorted(set(clean) - set(kept))) == ([], []) and kept == clean
    assert sum(r.doc_id is None for r in got) == 1
    assert all(r.ids == ",".join(map(str, full.encode_ordinary(texts[r.doc_id]))) and r.n_tokens == r.ids.count(",") + 1 for r in got)


def test_every_stage_keeps_columns_and_takes_no_rows(spark, corpus):
    path = corpus[0]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(3), path).columns == docs.columns
        assert stage(spark, docs.limit(0), path).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), path).count() == 0


def test_near_dedup_judges_rows(spark):
    """One id with two texts loses none; copies with null ids go."""
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(60)) for w in ("ka", "lo", "mi", "nu"))
    rows = [(1, a), (1, b), (1, a), (None, b + " ren"), (None, c), (None, c), (3, d + " ren"), (2, d), (None, ""), (None, ""), (4, None), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, a), (1, b), (None, c), (2, d), (None, ""), (4, None), (5, "")], key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_at_the_smallest_scale(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        diff, n = compare(df, connect(SF), ORACLES[name])
        assert not diff and n
    else:
        assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
        assert df.where(F.col("doc_id").isNull()).count() == 0


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert [int(q[2:].split("_")[0]) for q in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == list(range(1, 14))
    assert TOKENIZER


def test_a_stored_table_lets_the_driver_forget_what_is_done(spark):
    # shuffle files and plans of finished jobs go only once the driver has collected its garbage
    jvm = spark.sparkContext._jvm
    done = jvm.java.util.ArrayList()
    held = jvm.java.lang.ref.WeakReference(done)
    assert held.get() is not None
    del done
    gc.collect()
    stored(spark.range(3), "forget")
    gc.collect()
    stored(spark.range(3), "forget")
    assert held.get() is None
