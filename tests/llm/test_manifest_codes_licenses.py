"""Merkle manifest, vector codes and license scan against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from custodia.llm import codes, license_rules, licenses, merkle
from custodia.llm.queries import op11_merkle_manifest, op12_vector_codes, op13_license_scan

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, k string"

# manifest -------------------------------------------------------------------------------------------------------------


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(nodes):
    """(top, for every leaf its list of (left, right))."""
    steps, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            steps[i].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
            place[i] = p // 16
        nodes = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], steps


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0], plain_leaf(row, row[1]), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0], r[1] or 0, r[2]))
        trees[s] = plain_tree([r[2] for r in groups[s]])
    root, upper = plain_tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, upper):
        for (_, doc_id, leaf, row), steps in zip(groups[s], trees[s][1]):
            tampered = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0
            lowered = None if row[1] is None else re.sub("[A-Z]", lambda m: m[0].lower(), row[1])
            seen = plain_leaf(row, lowered) if tampered else leaf
            for left, right in steps + up:
                seen = h(left + seen + right)
            out.append((doc_id, leaf, trees[s][0], root, h("".join(a + b for a, b in steps + up)), seen, seen == root))
    return out


def manifest_rows(spark, tmp_path, rows):
    full = [(*r, "clash", "clash") for r in rows]
    spark.createDataFrame(full, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in op11_merkle_manifest(spark, str(tmp_path)).collect()]


def test_manifest_equals_plain_trees(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.choice(["Ab", "", None, "ß" * 5, "x" * 200]), rng.choice(["en", None]), "hot", rng.choice([i, None])) for i in range(9000)]
    # one leaf; exactly 16 and 17; a null group, an empty one, and more groups than one run holds
    for source, n in [("one", 1), ("b16", 16), ("b17", 17), (None, 40), ("", 3), ("é", 257)] + [(f"s{i}", 2) for i in range(30)]:
        rows += [(rng.randrange(10**9) - 5, f"T {source} {i}", "de", source, i) for i in range(n)]
    rows += [(None, "no id", "en", "hot", 1), (7, "Ab", "en", "hot", 7), (7, "Ab", "en", "hot", 7)]
    rng.shuffle(rows)
    got = manifest_rows(spark, tmp_path, rows)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(plain_manifest(rows), key=key)
    assert {r[6] for r in got} == {True, False}


def test_whole_blocks(spark, tmp_path):
    rows = [(i, "T", "en", "full", 1) for i in range(merkle.BLOCK)] + [(i, "T", "en", "over", 1) for i in range(merkle.BLOCK + 1)]
    assert sorted(manifest_rows(spark, tmp_path, rows)) == sorted(plain_manifest(rows))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_small_manifests(spark, tmp_path, rows):
    assert manifest_rows(spark, tmp_path, rows) == (plain_manifest(rows) if rows else [])


def test_witness_is_extended_by_later_siblings():
    tree = merkle.Subtree(2)
    run, slot = tree.append(h("0"))
    assert (run.digests, slot) == ([h("0")], 0)
    tree.append(h("1"))
    assert run.digests == [h("0"), h("1")]  # the first leaf's partial witness has grown
    for i in range(2, 20):
        tree.append(h(str(i)))
    top = tree.finish()
    assert (top, run.witness(0)[1]) == (plain_tree([h(str(i)) for i in range(20)])[0], [0, 0])


# codes ----------------------------------------------------------------------------------------------------------------


def plain_codes(rows, entries=16, rounds=6):
    """Whole numbers only, every distance computed."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    from fractions import Fraction

    vectors = [codes.parts_of([(Fraction(x) * 4096).__floor__() for x in r[1]], 8) for r in kept]
    books = [[v[p] for v in vectors[:entries]] for p in range(8)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [[min((apart(v[p], e), i) for i, e in enumerate(books[p])) for p in range(8)] for v in vectors]
    for _ in range(rounds):
        chosen = near()
        for p in range(8):
            for i in range(len(books[p])):
                mine = [v[p] for v, c in zip(vectors, chosen) if c[p][1] == i]
                if mine:
                    books[p][i] = [sum(xs) // len(mine) for xs in zip(*mine)]
    out = [(r[0], r[2], "".join(f"{i:02x}" for _, i in c), min(sum(d for d, _ in c), codes.LONGEST)) for r, c in zip(kept, near())]
    total = {}
    for _, label, _, error in out:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, code, error, min(total[label], codes.LONGEST), digest) for i, label, code, error in out]


def code_rows(spark, tmp_path, rows, kind="float"):
    spark.createDataFrame([(*r, b"x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, code binary, error int").write.parquet(f"{tmp_path}/embeddings.parquet")
    return [tuple(r) for r in op12_vector_codes(spark, str(tmp_path)).collect()]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def f32(values):
    return [float(np.float32(v)) for v in values]


def test_codes_equal_full_rescans(spark, tmp_path):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 24))
    rows = [(i, f32(centres[rng.integers(20)] + rng.normal(size=24) * 0.1), int(rng.integers(3)) if i % 7 else None) for i in range(600)]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 1), (None, rows[0][1], 0)]  # repeated ids, rows and a null id
    rows += [(-9, None, 1), (-8, f32([1.0] * 23) + [None], 1), (-7, f32([1.0] * 23) + [float("nan")], 1), (-6, f32([1.0] * 23) + [float("-inf")], 1)]
    rows += [(1000, f32([0.5] * 8), 1)]  # another length
    assert by_id(code_rows(spark, tmp_path, rows)) == by_id(plain_codes(rows))


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None, 1)],
        [(i, [float(i)] * 5, i % 2) for i in range(7)],  # fewer vectors than entries, no multiple of eight
        [(i, [0.0] * 16, None) for i in range(40)],  # ties everywhere
        [(1, [], 1), (2, [], 1)],
    ],
)
def test_small_code_tables(spark, tmp_path, rows):
    want = plain_codes(rows) if any(r[1] is not None for r in rows) else []
    assert by_id(code_rows(spark, tmp_path, rows)) == by_id(want)


def test_huge_components_are_exact(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.choice([1.0, -2.5, 3e9, -7e15, 2.0**70, 1e-9]) * rng.random() for _ in range(8)], i % 2) for i in range(60)]
    rows += [(100, [1.7e308] + [0.0] * 7, 0), (101, [-1.7e308] * 8, 0)]
    assert by_id(code_rows(spark, tmp_path, rows, "double")) == by_id(plain_codes(rows))


def test_bounds_save_rescans_and_never_err():
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(3000, 8, 4)) * 500 + rng.integers(-4000, 4000, size=(16, 8, 4))[rng.integers(16, size=3000)]).astype(np.int32)
    book = [[list(map(int, x[i, p])) for i in range(16)] for p in range(8)]
    history, s, rescans = [book], codes.State.unknown(len(x), 8), []
    for _ in range(6):
        rescans.append(codes.assign(x, s, codes.Bounds(history)))
        new = []
        for p in range(8):
            d = codes.distances(x[:, p], np.array(history[-1][p]))
            assert (s.own[:, p] == d.argmin(axis=1)).all()
            new.append([[int(v) for v in np.floor(x[s.own[:, p] == e, p].mean(axis=0))] if (s.own[:, p] == e).any() else history[-1][p][e] for e in range(16)])
        history.append(new)
    assert rescans[0] == 3000 * 8 and rescans[-1] < 3000 * 8 / 4
    # the net displacement is never more than the sum of the moves
    b = codes.Bounds(history)
    steps = [codes.Bounds(history[: i + 2]).moved for i in range(6)]
    for p in range(8):
        drift = sum(moved[p][i] for i, moved in enumerate(steps))
        assert (b.moved[p][0] <= drift * (1 + 1e-9)).all() and (b.moved[p][0] < drift * 0.999).any()


# licenses -------------------------------------------------------------------------------------------------------------

RULES = licenses.table_of()
SCANNER = licenses.Scanner(RULES)


def test_hundreds_of_rules():
    assert len(RULES) > 300 and {r.kind for r in RULES} == set(license_rules.KINDS)


@pytest.mark.parametrize("number", range(len(RULES)))
def test_keyword_is_in_all_that_a_rule_matches(number):
    rule = RULES[number]

    @given(st.from_regex(re.compile(rf"(?:{rule.expression})", re.ASCII), fullmatch=True))
    @settings(max_examples=8, deadline=None, database=None, suppress_health_check=list(HealthCheck))
    def check(words):
        assert rule.keyword in words
        assert licenses.words_of(words)[0] == words
        assert number in SCANNER.candidates(words)

    check()


def plain_scan(text):
    """Every rule on every text, every pair of detections compared."""
    words = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    line = b" ".join(words).decode("latin-1")
    order = list(license_rules.KINDS)
    hits = []
    for i, r in enumerate(RULES):
        for m in re.finditer(rf"(?:(?<=^)|(?<= ))(?:{r.expression})(?= |$)", line):
            hits.append((order.index(r.kind), m.start(), m.end(), i, r))

    def within(a, b):
        """a is suppressed by b."""
        if a is b or not (b[1] <= a[1] and a[2] <= b[2]) or b[0] > a[0]:
            return False
        return b[0] < a[0] or (b[1], b[2]) != (a[1], a[2]) or b[3] < a[3]

    strong = [x for x in hits if not any(within(x, y) for y in hits)]
    base = [len(line[: x[1]].split()) for x in hits if x[4].kind == "base"]
    label = {x[4].label for x in strong if x[4].kind != "hint"} | {x[4].label for x in hits if x[4].kind == "base"}
    score = 1.0
    for x in strong:
        score *= 1 - license_rules.KINDS[x[4].kind]
    at = (min(base), max(base)) if base else (None, None)
    return (len(words), len(base), *at, ",".join(sorted({x[4].label for x in hits if x[4].kind == "base"})), ",".join(sorted(label)), round(1 - score, 9))


PIECES = [
    "GNU General Public License", "gnu general public license version 3 or (at your option) any later version", "Apache License", "Apache License, Version 2.0", "CC BY", "CC-BY-NC 4.0",
    "MIT License", "mit", "license", "SPDX-License-Identifier: GPL-2.0-or-later", "https://creativecommons.org/licenses/by-sa/4.0/", "Größe", "\x00", "public domain", "LGPLv3",
    "licensed under", "released under the", "all rights reserved", "Copyright (c) 2020 The Authors", "cc", "by", "by-nc", "gnu", "中文", "2.0", "word" * 50,
]


def test_scan_equals_all_rules_on_all_texts(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", " \n", "MIT License", "mit licenses", "submit license", "É mit license é", "CC BY CC BY cc by"]
    texts += [rng.choice([" ", "\n", ", "]).join(rng.choices(PIECES, k=rng.randrange(1, 25))) for _ in range(250)]
    texts += [" ".join(rng.choices(PIECES, k=8000))]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(3, "MIT License", None, None), (None, "MIT License", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, id string, detections string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, *(tuple(r)[1:-1]), round(r.score, 9)) for r in op13_license_scan(spark, str(tmp_path)).collect()]
    assert by_id([tuple("" if v is None else v for v in r) for r in got]) == by_id([tuple("" if v is None else v for v in (i, *plain_scan(t))) for i, t, *_ in rows])


def test_scan_of_an_empty_table(spark):
    assert licenses.detections(spark.createDataFrame([], "doc_id string, text string"), "doc_id", "text").select("id", licenses.score("detections")).collect() == []


def test_priorities(spark):
    def labels(text):
        rows = licenses.detections(spark.createDataFrame([(1, text)], "a int, b string"), "a", "b")
        return rows.select(licenses.labels("detections"), F.round(licenses.score("detections"), 3)).first()

    assert tuple(labels("Licensed under CC BY-NC 4.0.")) == ("cc-by,cc-by-nc", 0.9)
    assert tuple(labels("see http://www.gnu.org/licenses/gpl-3.0.html, or ask for GPLv2")) == ("gpl-2.0,gpl-3.0", 0.985)
    assert tuple(labels("a copyleft tale")) == ("", 0.2)
