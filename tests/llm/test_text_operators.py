"""Chat formatting, token counts, URL rules, quality rules and BPE against plain Python."""

import base64
import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from custodia.llm import bpe, chat, rules, tokencount, urlfilter
from custodia.llm.queries import GLOBS, HOSTILE, RULES, TOKENIZER, op1_chat_format

ODD = ["", None, "a" * 3000, "\n" * 900, " " * 300 + "x", "é" * 100, "#" * 700 + "$" * 301, "中文字符" * 60, "don't you'll 's <|endoftext|> \x00\x1c x", " you you" * 20, "a  b c\td "]


def reference() -> tiktoken.Encoding:
    with open(TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# chat -----------------------------------------------------------------------------------------------------------------


@given(st.lists(st.tuples(st.text(alphabet="ab\\<|\nn>imstart_end", max_size=12), st.text(alphabet="ab\\<|\n>im_startend", max_size=30)), max_size=5))
@settings(max_examples=300, deadline=None)
def test_rendering_is_reversible(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert chat.masked(formatted, spans) == "".join(t for r, t in turns if r == "assistant")
    assert formatted.count(chat.START) == formatted.count(chat.END) == len(turns)


def test_paths_of_a_tree(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 2.0), (1, 4, 3, "user", None, None)]
    rows += [(1, 5, 3, "user", "d", float("nan")), (None, 1, None, "user", "n", 1.0), (2, 1, 99, "user", "orphan", 1.0)]
    rows += [(3, 1, 2, "user", "x", 1.0), (3, 2, 1, "user", "y", 1.0), (3, 3, 1, "user", "below a cycle", 1.0)]
    nodes = spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score double")
    got = {(r.tree_id, r.leaf_id): [r2["text"] for r2 in r.turns] for r in chat.read_back(chat.format_trees(nodes)).collect()}
    assert got == {(1, 2): ["q", "a"], (1, 4): ["q", "b", ""], (1, 5): ["q", "b", "d"], (None, 1): ["n"], (2, 1): ["orphan"]}
    best = {(r.tree_id, r.leaf_id) for r in chat.format_trees(nodes, best=1).collect()}
    assert best == {(1, 4), (None, 1), (2, 1)}


def test_long_chain_in_few_rounds(spark):
    n = 300
    rows = [(7, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(n)]
    nodes = spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score double")
    (row,) = chat.read_back(chat.format_trees(nodes)).collect()
    assert [t["text"] for t in row.turns] == [str(i) for i in range(n)]


def test_turns_with_ties_and_nulls(spark, tmp_path):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", HOSTILE)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "y").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in op1_chat_format(spark, str(tmp_path)).collect()}
    assert set(got) == {1, None, -1}
    assert got[1].turns_sha256 == hashlib.sha256(b"\n\nuser\na\nuser\nb\n").hexdigest()
    assert (got[None].loss_chars, got[-1].n_turns) == (len(HOSTILE), 2)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_trees(chat.turns_as_nodes(empty)).count() == 0


# token counts -----------------------------------------------------------------------------------------------------------


def test_edits_equal_full_encoding():
    count, full, rng = tokencount.piece_counts(TOKENIZER), reference(), random.Random(5)
    letters = "ab'srevl t  \n\n\t12é#!  're中"
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 20, 200, 2000])))
        tree = tokencount.tree_of(text, count)
        for step in range(6):
            if step == 3:
                tree = tokencount.SegmentTree.unpack(tree.pack())
            inserted = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 10, 500])))
            text, again = tree.edit(text, rng.randint(-2, len(text) + 2), rng.choice([0, 0, 1, 3, 50, 2000]), inserted, count)
            assert (tree.n_chars, tree.n_tokens) == (len(text), len(full.encode_ordinary(text)))


def test_an_edit_touches_little():
    count, text = tokencount.piece_counts(TOKENIZER), "some words here. " * 5000
    tree = tokencount.tree_of(text, count)
    assert tree.edit(text, 40_000, 3, "other", count)[1] < 40


def test_edit_frames(spark):
    rows = [(1, "hello world", [(0, 5, "bye"), (99, 4, None)], "x"), (1, None, None, "x"), (None, "", [(None, None, "new text")], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start: int, deleted: int, inserted: string>>, n_tokens string")
    got = tokencount.apply_edits(tokencount.build(docs, TOKENIZER), TOKENIZER).collect()
    full = reference()
    assert {(r.doc_id, r.text, r.n_tokens) for r in got} == {(i, t, len(full.encode_ordinary(t))) for i, t in [(1, "bye world"), (1, ""), (None, "new text")]}
    assert tokencount.build(docs.limit(0), TOKENIZER).count() == 0


# BPE --------------------------------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark):
    rows = [(i, t, "extra") for i, t in enumerate(ODD)] + [(None, "null id", "x"), (3, "same id", "x"), (3, "same id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    full, got = reference(), bpe.encode_decode(docs, TOKENIZER).collect()
    want = collections.Counter((i, ",".join(map(str, full.encode_ordinary(t or ""))), (t or "").encode()) for i, t, _ in rows)
    assert collections.Counter((r.doc_id, r.ids, bytes(r.decoded)) for r in got) == want
    assert all(r.n_tokens == len(full.encode_ordinary(t or "")) for r in got for i, t, _ in rows[:3] if r.doc_id == i)
    assert bpe.encode_decode(docs.limit(0), TOKENIZER).count() == 0


def test_bpe_splits_only_chunks_that_are_not_plain_letters(monkeypatch):
    seen = []

    class Split:
        def findall(self, text, split=bpe._SPLIT):
            seen.append(text)
            return split.findall(text)

    own, full = bpe.Tokenizer(TOKENIZER), reference()
    monkeypatch.setattr(bpe, "_SPLIT", Split())
    texts = ["Plain letters ABC only", "don't 12ab straße ſ a\u0301 x\ny", "letters", "qzxvkwq qzxvkwqj " * 50 + "z"]
    found = [(i, d) for ids, data in own.run(texts) for i, d in zip(ids, data)]
    assert [i for i, _ in found] == [",".join(map(str, full.encode_ordinary(t))) for t in texts] and [d.decode() for _, d in found] == texts
    assert sorted(set(seen)) == sorted(["don't", " 12ab", " straße", " ſ", " a\u0301", " x\ny"])


@given(st.lists(st.text(alphabet="abthe ingo'n1\n中#", max_size=40), max_size=6))
@settings(max_examples=40, deadline=None)
def test_bpe_random_texts(texts):
    own, full = bpe.tokenizer(TOKENIZER), reference()
    ids = [x for a, _ in own.run(texts) for x in a]
    assert ids == [",".join(map(str, full.encode_ordinary(t))) for t in texts]


def test_long_words_are_restarted(monkeypatch):
    monkeypatch.setattr(bpe, "STEP_ROWS", 1)
    own, full, rng = bpe.Tokenizer(TOKENIZER), reference(), random.Random(1)
    texts = ["".join(rng.choice("abcdet") for _ in range(n)) for n in (40, 400)]
    assert [x for a, _ in own.run(texts) for x in a] == [",".join(map(str, full.encode_ordinary(t))) for t in texts]


def test_decode(spark):
    full = reference()
    rows = [(1, full.encode_ordinary("so geht das\n")), (2, []), (3, None)]
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), TOKENIZER).collect()}
    assert got == {1: b"so geht das\n", 2: b"", 3: b""}


# URL rules --------------------------------------------------------------------------------------------------------------


def plain_verdict(url):
    host, path = "", ""
    if url and "://" in url:
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    hit = any(g.strip("*") in host + path for g in GLOBS)
    return host, path, best.text if best else None, best.verdict if best else "block" if hit else "allow"


def test_urls(spark):
    parts = ["http://", "https://X.", "a.example.net", "example.com", "org", ".NET", "net", "/en/", "/de/", "/fr/", "?q=/de/", "#x", "casino", "\n", "é", "://", "/"]
    rng = random.Random(3)
    urls = [None, "", "net/", "http://net", "http://net/", "http://xnet/", "http://a.net?/", "http://" + "x" * 5000 + ".net/"] + ["".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(600)]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(None, "http://net/", "r")] * 2, "page_id long, url string, rule string")
    got = urlfilter.judge(pages, RULES, GLOBS).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got if r.page_id is not None} == {i: plain_verdict(u) for i, u in enumerate(urls)}
    assert sum(r.page_id is None for r in got) == 2
    assert urlfilter.judge(pages.limit(0), RULES, GLOBS).count() == 0


@given(st.lists(st.text(alphabet="ab*?", max_size=70), max_size=4), st.lists(st.text(alphabet="ab", max_size=90), max_size=4))
@settings(max_examples=200, deadline=None)
def test_automaton_equals_regular_expressions(globs, urls):
    got = urlfilter.Automaton([urlfilter.glob_pattern(g) for g in globs]).run([u.encode() for u in urls])
    want = [[bool(re.fullmatch("".join(".*" if c == "*" else "." if c == "?" else c for c in g), u)) for g in globs] for u in urls]
    assert got.tolist() == want


# quality rules ----------------------------------------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@given(st.text(alphabet="ab #|\n\té ", max_size=60))
@settings(max_examples=300, deadline=None)
def test_base_counts(text):
    assert rules.base_counts(text, rules.hash_cache()) == plain_counts(text)


def test_log_ratio_of_a_small_corpus(spark):
    good, bad = " ".join(f"word{i} of" for i in range(60)), " ".join(f"junk{i}### $$$ |" for i in range(60))
    rows = [(1, good, 1), (2, good + "x", 1), (3, bad, 1), (4, bad + "y", 1), (5, None, 1), (None, good, 1), (1, good, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    model = rules.fit(docs, spark.createDataFrame([(1,), (2,), (None,)], "i long"))
    cache, n = rules.token_cache(), rules.BUCKETS
    raw, trusted = (np.bincount(np.concatenate([rules.buckets(t, cache) for i, t, _ in rows if keep(i)]), minlength=n) for keep in (lambda i: True, lambda i: i in (1, 2)))
    want = [math.log(0.99 * t / trusted.sum() * raw.sum() / r + 0.01) if r else 0 for t, r in zip(trusted, raw)]
    assert np.allclose(model.weights, want)
    got = rules.apply(docs, model).collect()
    assert {(r.doc_id, r.kept) for r in got} == {(1, True), (2, True), (3, False), (4, False), (5, False), (None, True)}
    assert all(math.isclose(r.score, model.score(t, cache)) for r in got for i, t, _ in rows if i == r.doc_id)
    assert rules.apply(docs.limit(0), rules.fit(docs.limit(0), docs.select("doc_id").limit(0))).count() == 0


def test_every_good_document_is_counted(spark, tmp_path, monkeypatch):
    from custodia.llm import queries

    monkeypatch.setattr(queries, "MAX_LABELLED", 2, raising=False)  # the cap that was here
    rows = [(i, f"{'plain' if i < 30 else 'other'} word{i} " * 60) for i in range(40)] + [(None, "free text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(40)] + [(None, 1)], "doc_id long, quality int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    cache, n = rules.token_cache(), rules.BUCKETS
    raw, trusted = (np.bincount(np.concatenate([rules.buckets(t, cache) for i, t in rows if keep(i)]), minlength=n) for keep in (lambda i: True, lambda i: i is not None and i < 30))
    want = rules.ratio(trusted, raw)
    got = {r.doc_id: r.score for r in queries.op8_quality_rules(spark, str(tmp_path)).collect()}
    assert got == pytest.approx({i: want.score(t, cache) for i, t in rows})


def test_given_ids_are_decoded(monkeypatch):
    """A fault in the ids shows in the bytes decoded from them."""
    own = bpe.Tokenizer(TOKENIZER)
    monkeypatch.setattr(bpe, "DECODE_CHARS", 20)
    texts = ["the cat sat on the mat", "", "h\u00e9llo  w\u00f6rld \U0001f600", "a", "the cat sat on the mat"]
    ids = [x for block, _ in own.run(texts) for x in block]
    assert own.decode_joined(ids) == [x.encode() for x in texts]
    assert own.decode_joined([ids[0].rpartition(",")[0]]) != [texts[0].encode()]
