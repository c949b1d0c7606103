"""Decontamination, near duplicates, components, classifiers and the language model against brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custodia.llm import components as components_module
from custodia.llm import decontaminate, minhash, pylm, quality, toxicity
from custodia.llm.common import dropped, hash_cache, lower_words, stored, stored_by
from custodia.llm.components import components

RNG = random.Random(17)
VOCABULARY = [f"w{i}" for i in range(400)]


def text(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# components -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(60)], [(9, i) for i in range(40)], [(RNG.randrange(80), RNG.randrange(80)) for _ in range(60)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == union_find(nodes, [e for e in edges if e[0] != e[1]])


# near duplicates ----------------------------------------------------------------------------------------------------------


def brute_force(rows, n, percent=80):
    cache = hash_cache()

    def shingles(t):
        w = lower_words(t)
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    assert all(len(minhash.shingles(t, cache, n)) == len(s) for (_, t), (_, s) in zip(rows, sets))
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if None not in (a, b) and x and y and 100 * len(x & y) >= percent * len(x | y)]
    of = union_find({i for i, _ in rows if i is not None}, links)
    return sorted((i if i is not None else -1, len(s), -1 if i is None else i if not s else of[i]) for i, s in sets)


def variants(base, n):
    """Chains of edits: neighbours are similar, the ends are not."""
    words, out = base.split(), [base]
    for k in range(n):
        words = list(words)
        words[(k * 13) % len(words)] = f"edit{k}"
        out.append(" ".join(words))
    return out


def test_near_duplicates_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SALT_ROWS", 3)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    common = text(70)
    texts_ = ["", None, " \n", "one two", "ONE\ttwo", "one two three", *variants(text(90), 25), *variants(text(200), 12)]
    texts_ += [f"{common} {text(RNG.randint(5, 60))}" for _ in range(40)] + [text(40)] * 6 + [text(30) for _ in range(10)]
    rows = [(100 + i, t) for i, t in enumerate(texts_)] + [(None, texts_[8]), (None, ""), (120, texts_[50]), (120, texts_[50])]
    RNG.shuffle(rows)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, signature string, component_id int")
    got = minhash.near_duplicates(docs, n=4).collect()
    # an id with several texts: texts without shingles are linked with nothing but keep the id
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got) == brute_force(rows, 4)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_no_documents_and_unrelated_documents(spark):
    docs = spark.createDataFrame([(1, text(30)), (2, text(30))], "doc_id long, text string")
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    assert {r.component_id for r in minhash.near_duplicates(docs).collect()} == {1, 2}


@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
@settings(max_examples=200, deadline=None)
def test_similarity_of_sets(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    if a and b:
        assert minhash.similar(x, y, 80) == (100 * len(a & b) >= 80 * len(a | b))


# decontamination ----------------------------------------------------------------------------------------------------------


def test_containment_equals_brute_force(spark):
    import re

    items = [(i, text(RNG.randint(6, 40))) for i in range(12)] + [(50, "tiny"), (51, "two words"), (52, ""), (53, None), (54, "...!"), (None, text(9)), (3, text(12))]
    docs = []
    for k in range(60):
        body = text(RNG.choice([0, 3, 50, 900]))
        if k % 2:
            passage = (RNG.choice(items)[1] or "").split()
            passage = passage[: max(0, len(passage) - RNG.choice([0, 0, 1, 5]))]
            body = f"{body}\n{' '.join(passage).upper()}, {text(20)}"
        docs.append((k if k != 7 else None, body))
    docs += [docs[3], docs[3], (3, "tiny"), (99, None), (99, "the two, WORDS!")]

    def shingles(t, n):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want, dirty = set(), set()
    for (d, t), (m, u) in itertools.product(set(docs), set(items)):
        width = min(5, len(re.findall(r"[^\W_]+", u or "")))
        need = shingles(u, width) if width else set()
        both = len(need & shingles(t, width)) if width else 0
        if need and both >= math.ceil(0.8 * len(need)):
            want.add((d, m, len(need), both))
            dirty.add((d, t))
    frame = spark.createDataFrame([(*d, "x", 0) for d in docs], "doc_id long, text string, item string, h int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained(frame, bench)
    assert sorted(map(str, ((r.id, r.item, r.n_item_shingles, r.n_shared) for r in got.collect()))) == sorted(map(str, want))
    assert len(want) > 10
    assert not any("Python" in x or "Arrow" in x for x in [got._jdf.queryExecution().toString()])
    kept = decontaminate.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, (d for d in docs if d not in dirty)))
    for a, b in ((frame.limit(0), bench), (frame, bench.limit(0)), (frame, bench.where("item_id = 52"))):
        assert decontaminate.contained(a, b).count() == 0
        assert decontaminate.clean(a, b).count() == a.count()


# toxicity -----------------------------------------------------------------------------------------------------------------


def toxic_rows(n, start=0):
    out = []
    for i in range(start, start + n):
        bad = i % 5 == 0
        out.append((i, text(60) + (RNG.choice([" idiot ", " zzqaxen ", " zzqaxur ", " Clown! "]) if bad else ""), int(bad)))
    return out


def test_toxic_texts_are_found(spark):
    rows = toxic_rows(900)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id long, text string, positive string, h string")
    model = toxicity.fit(docs, spark.createDataFrame([(i,) for i, _, y in rows if y], "i long"), 0.2)
    fresh = toxic_rows(300, 5000) + [(9001, "", 0), (9002, None, 0), (9003, "zzqaxol " * 9000, 1), (None, "idiot", 1), (9004, "idiot", 1), (9004, "idiot", 1)]
    got = toxicity.apply(spark.createDataFrame([(i, t) for i, t, _ in fresh], "doc_id long, text string"), model).collect()
    assert [r.__predicted for r in got if False] == []
    assert sorted((str(r.doc_id), r["__predicted"]) for r in got) == sorted((str(i), y) for i, _, y in fresh)
    assert all(0 <= r["__score"] <= 1 for r in got)


def test_toxicity_without_positives(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "i long")
    for d in (docs, docs.limit(0)):
        model = toxicity.fit(d, none, 0.1)
        assert all(math.isclose(r["__score"], 0.1) for r in toxicity.apply(docs, model).collect())


def test_negative_part_of_the_risk_is_not_fitted():
    # positives and unlabelled rows are alike: the corrected risk keeps the score near the prior
    rows, cols = np.arange(40), np.zeros(40, int)
    half = np.arange(40) < 20
    w, b = toxicity.nnpu(rows, cols, half.astype(float), (~half).astype(float), 1, 0.3)
    assert 0.1 < 1 / (1 + math.exp(-(w[0] + b))) < 0.6


# quality ------------------------------------------------------------------------------------------------------------------


def test_context_sums_by_hand():
    plus, minus = quality.index_vectors(50, 8)
    docs = [np.array([1, 2, 3, 2]), np.array([], int), np.array([4])]
    want = np.zeros((50, 8))
    for d in docs:
        for i, j in itertools.permutations(range(len(d)), 2):
            if abs(i - j) <= quality.REACH:
                want[d[i], plus[d[j]]] += 1
                want[d[i], minus[d[j]]] -= 1
    assert np.array_equal(quality.context_sums(docs, 50, 8), want)


def test_pooling_does_not_depend_on_chunks(monkeypatch):
    vectors, t = np.random.default_rng(1).normal(size=(64, 4)).astype(np.float32), text(500)
    whole = quality.pooled(t, vectors, quality.token_cache(64))
    monkeypatch.setattr(quality, "CHUNK", 7)
    assert np.allclose(whole, quality.pooled(t, vectors, quality.token_cache(64)), atol=1e-5)


def quality_rows(n, start=0):
    return [(i, text(80) if i % 4 else " ".join(f"{w}###" for w in text(80).split()), int(i % 4 > 0)) for i in range(start, start + n)]


def test_quality_is_learnt_and_calibrated(spark):
    rows = quality_rows(600)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, y string")
    known = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, known)
    fresh = quality_rows(200, 1000)
    got = {r.doc_id: r for r in quality.apply(spark.createDataFrame([(i, t) for i, t, _ in fresh], "doc_id long, text string"), model).collect()}
    assert np.mean([got[i]["__predicted"] == y for i, _, y in fresh]) > 0.98
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "word " * 50_000)], "doc_id long, text string")
    assert all(0 <= r["__score"] <= 1 for r in quality.apply(odd, model).collect())
    for d, k in ((docs.limit(0), known), (docs, known.limit(0)), (docs, known.where("quality = 1"))):
        scores = [r["__score"] for r in quality.apply(odd, quality.fit(d, k)).collect()]
        assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)


def test_temperature_softens_an_overconfident_network():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 60))
    y = (x[:, 0] + rng.normal(size=1500) * 2 > 0).astype(float)
    assert quality.train(x, y).temperature > 1


def test_a_round_of_components_is_no_plan_of_many_copies(spark, monkeypatch):
    scans = []
    monkeypatch.setattr(components_module, "stored", lambda df, name: scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")) or stored(df, name))
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(20, 21)], "u long, v long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(13)} | {20: 20, 21: 20}
    assert len(scans) > 2 and max(scans) <= 6  # 24 where the large-star step stands in the small-star step's plan


# language model -----------------------------------------------------------------------------------------------------------


def lm_rows(n):
    out = [(i, " ".join(RNG.choices(VOCABULARY[:40], weights=range(1, 41), k=RNG.randint(0, 60)))) for i in range(n)]
    return out + [(None, "w1 w2."), (7, None), (7, "W3 unseen-word!"), (8, "w1 " * 3000)]


def test_base_scores_and_counts(spark, monkeypatch):
    monkeypatch.setattr(pylm, "BLOCK_TOKENS", 400)
    rows = lm_rows(120)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, training string, n int")
    got = pylm.score(docs, docs.doc_id % 3 != 1).collect()
    tokens = [lower_words(t) + [None] for _, t in rows]
    train = [w for (i, _), t in zip(rows, tokens) if i is not None and i % 3 != 1 for w in t]
    counts = {w: train.count(w) for w in set(train)}
    n, v = len(train), len(counts)
    want = sorted((str(i), len(t), sum(w in counts for w in t), round(sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in t), 6)) for (i, _), t in zip(rows, tokens))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_a_context_is_the_word_before(spark):
    # "cat" and "bat" are of one class: only their own restaurants tell what follows them
    assert pylm.context_of(b"cat") == pylm.context_of(b"bat")
    rows = [(i, "cat alpha bat omega") for i in range(200)] + [(1000, "cat alpha"), (1001, "cat omega"), (1002, "bat omega"), (1003, "bat alpha")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in pylm.score(docs, docs.doc_id < 1000).where("doc_id >= 1000").collect()}
    ends = {r.doc_id: r.score for r in pylm.score(spark.createDataFrame([*rows[:200], (1004, "alpha"), (1005, "omega")], docs.schema), F.col("doc_id") < 1000).collect()}
    assert got[1000] - ends[1004] > got[1001] - ends[1005] + 1 and got[1002] - ends[1005] > got[1003] - ends[1004] + 1


def test_totals_of_a_word_s_restaurant_are_those_of_all_buckets(spark, monkeypatch):
    monkeypatch.setattr(pylm, "BLOCK_TOKENS", 300)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["a", "b.", "cat", "bat", "x1"] + VOCABULARY[:20], k=rng.randint(0, 40)))) for i in range(60)] + [(60, None), (60, "a a a")]
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("training", F.col("id") % 3 != 1)
    packed = pylm.stored(pylm.pack(docs, 4), "packed")
    counts = pylm.stored(pylm.gather(packed, 4), "counts")
    pairs = Counter()
    for i, text in rows:
        if i % 3 != 1:
            words = [pylm.END, *map(pylm.key_of, lower_words(text)), pylm.END]
            pairs.update(zip(words, words[1:]))
    asks = counts.where("target is not null").selectExpr("target AS bucket", "bucket AS source", "keys", "customers", "single", "twice")
    states = counts.where("target is null")
    slots = {r.bucket: np.frombuffer(r.slots, np.uint64) for r in states.select("bucket", "slots").collect()}
    got = {}
    for r in sorted(pylm.first_replies(asks).collect(), key=lambda r: r.source):
        got.setdefault(r.bucket, []).append((np.frombuffer(r.customers, np.int64), np.frombuffer(r.single, np.int64)))
    assert any(len(x) for x in slots.values())
    for bucket, keys in slots.items():
        customers, single = (np.concatenate([p[k] for p in got[bucket]]) for k in (0, 1))
        assert customers.tolist() == [sum(n for (a, _), n in pairs.items() if a == k) for k in keys.tolist()]
        assert single.tolist() == [sum(n == 1 for (a, _), n in pairs.items() if a == k) for k in keys.tolist()]
    # after a message per bucket, each context has one table per pair that stands twice
    again = {}
    for r in sorted(pylm.replies(pylm.sent(states, "leaf_tables", 4)).collect(), key=lambda r: r.source):
        again.setdefault(r.bucket, []).append(np.frombuffer(r.tables, np.int64))
    for bucket, keys in slots.items():
        if len(keys):
            assert np.concatenate(again[bucket]).tolist() == [sum(n > 1 for (a, _), n in pairs.items() if a == k) for k in keys.tolist()]


def test_tables_by_bucket_are_not_shuffled_again(spark):
    left = spark.range(500).selectExpr("cast(id % 7 AS int) AS bucket", "id")
    right = spark.range(7).selectExpr("cast(id AS int) AS bucket", "id * 10 AS more")
    a, b = stored_by(left, "left", "bucket", 4), stored_by(right, "right", "bucket", 4)

    def add(x, y):
        import pyarrow as pa

        return pa.table({"bucket": y.column("bucket"), "n": pa.array([x.num_rows + y.column("more")[0].as_py()], pa.int64())})

    done = a.groupBy("bucket").cogroup(b.groupBy("bucket")).applyInArrow(add, "bucket int, n long")
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    assert {r.bucket: r.n for r in done.collect()} == {k: len(range(k, 500, 7)) + 10 * k for k in range(7)}
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(("llm_left", "llm_right"))]
    dropped(a)
    dropped(b)
    assert len(names) == 2 and not any(spark.catalog.tableExists(n) for n in names)


def test_language_model_shuffles_no_words(spark, monkeypatch):
    # the packed words are the largest table: what groups them must read them where they lie
    seen = []
    monkeypatch.setattr(pylm, "stored_by", lambda df, name, *a: seen.append((name, df._jdf.queryExecution().executedPlan().toString())) or stored_by(df, name, *a))
    docs = spark.createDataFrame(lm_rows(30)[:30], "doc_id long, text string")
    done = pylm.score(docs, docs.doc_id % 3 != 1)
    plans = dict(seen)
    assert "Exchange" not in plans["counts"] and plans["seats1"].count("Exchange") == 2 and done.count() == 30


def test_probabilities_after_a_word_add_up_to_one():
    rng = np.random.default_rng(11)
    count = rng.integers(0, 5, 40)
    tables, above = np.minimum(count, rng.integers(1, 4, 40)), rng.dirichlet(np.ones(40))
    assert math.isclose(pylm.word_probability(count, tables, count.sum(), tables.sum(), 0.6, above).sum(), 1, rel_tol=1e-9)


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id long, text string")
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in pylm.score(docs, F.lit(False)).collect()}
    assert got[1].train_tokens == 0 and math.isclose(got[1].score, 0) and got[2].n_tokens == 1
    assert pylm.score(docs.limit(0), F.lit(True)).count() == 0


def small_state():
    rng = np.random.default_rng(5)
    own = rng.integers(1, 5, 30)
    context = np.concatenate([np.sort(rng.choice([0, 1, 2, 8, 9, 40, 100], k, replace=False)) for k in own])
    return pylm.State(np.arange(30, dtype=np.uint64) * 512, own, context, rng.integers(1, 90, own.sum()))


def test_probabilities_of_a_context_add_up_to_one():
    state = small_state()
    vocabulary = len(state.word)
    for number in range(3):
        seats = pylm.Seats.of(state.seats, vocabulary)
        state = pylm.sweep(state, seats, np.random.default_rng(number), False)
    seats = pylm.Seats.of(state.seats, vocabulary)
    root = seats.root(state.upper[:, :-1].sum(axis=1), state.upper[:, -1])
    unknown = seats.back(2) * seats.base
    assert math.isclose(root.sum() + unknown.item(), 1, rel_tol=1e-9)
    parents = seats.parents(state.parent_customers(), state.upper[:, :-1], root)
    assert np.allclose((parents.sum(axis=0) + seats.back(1) * unknown)[np.unique(pylm.PARENT[state.context])], 1)
    p = seats.contexts(state, parents)
    for u in np.unique(state.context):
        seen = state.at[state.context == u]
        rest = np.setdiff1d(np.arange(vocabulary), seen)
        total = p[state.context == u].sum() + seats.back(0)[u] * (parents[rest, pylm.PARENT[u]].sum() + seats.back(1)[pylm.PARENT[u]] * unknown.item())
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_seating_follows_the_restaurant():
    # mean number of tables of n customers with one dish that always fits a new table: (theta + d)_n / (theta + 1)_(n-1) / d - theta / d
    d, n = 0.5, 50
    t = pylm.seat(np.full(4000, n), np.full(4000, 1e-12), d, np.random.default_rng(1))
    assert t.max() == 1 and pylm.seat(np.array([0, 1, 5]), np.full(3, 1e12), d, np.random.default_rng(1)).tolist() == [0, 1, 5]
    many = pylm.seat(np.full(300, 100_000), np.full(300, 1.0), d, np.random.default_rng(2)).mean()
    step = np.ones(300)
    rng = np.random.default_rng(3)
    for k in range(1, 100_000):
        step += rng.random(300) < 1.0 / (1.0 + k - d * step)
    assert abs(many - step.mean()) < 0.08 * step.mean()
