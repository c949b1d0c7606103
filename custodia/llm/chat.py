"""Chat formatting: reply trees become conversations, one per chosen root-to-leaf path.

Paths are enumerated with self-joins that double their reach: first the ancestor 2^k steps up of
every node, then, from the leaves, the largest step first, every ancestor of every leaf exactly
once. The number of rounds is the logarithm of the depth. Paths of a tree are ranked level by
level, the branch with the higher score first, then the smaller node id.

The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles every
``<``, any backslashes, ``|`` gets one more backslash, so no control string can arise from a text
and the step back is exact; in roles, backslashes and line ends are doubled or written ``\\n`` first.

Results for odd input: null role, text: empty. Null tree ids form one tree of their own. A parent that
does not exist makes its child a root. Nodes on a cycle have no root, so no path holds them, and a
leaf below a cycle has no path. Null or NaN scores rank last. Repeated (tree, node) rows would be
two nodes with one name: pass ids that are unique, as ``turns_as_nodes`` makes them. Extra
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custodia.llm.common import map_arrow
from custodia.session import pinned

START, END = "<|im_start|>", "<|im_end|>"
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_BACK = re.compile(r"\\(.)", re.S)
#: Salts of the first step when the best paths of one tree are picked.
SALTS = 32


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_BACK.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans under the loss mask, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        part = f"{head}{body}{END}\n"
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted text; the inverse of ``render``."""
    out = []
    for part in formatted.split(f"{END}\n")[:-1]:
        role, _, text = part.removeprefix(START).partition("\n")
        out.append((unescape_role(role), unescape(text)))
    return out


def masked(formatted: str, spans: list[tuple[int, int]]) -> str:
    """Text under the loss mask, without escapes."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def turns_as_nodes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A plain list of turns as a tree with one branch; ties of turn go by role, then text."""
    order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col(role), F.col(text))
    return turns.select(conv, turn, role, text).withColumn("node_id", F.row_number().over(order).cast("long")).select(
        F.col(conv).alias("tree_id"),
        "node_id",
        F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
        F.lit(0.0).alias("score"),
    )


def _same(left: DataFrame, right: DataFrame, *pairs: tuple[str, str]):
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def paths(nodes: DataFrame) -> DataFrame:
    """(tree_id, leaf_id, node_id, up): every node of every root-to-leaf path, ``up`` steps above its leaf."""
    links = pinned(nodes.select("tree_id", "node_id", "parent_id", "score"))
    known = links.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    parents = links.where(F.col("parent_id").isNotNull())
    jump = parents.join(known, parents.tree_id.eqNullSafe(known.t) & (parents.parent_id == known.n)).select(
        "tree_id", F.col("node_id").alias("low"), F.col("parent_id").alias("high")
    )
    jumps = [pinned(jump)]
    largest = links.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0
    while 2 ** len(jumps) <= largest:
        last = jumps[-1]
        upper = last.select(F.col("tree_id").alias("t"), F.col("low").alias("mid"), F.col("high").alias("top"))
        longer = pinned(last.join(upper, last.tree_id.eqNullSafe(upper.t) & (last.high == upper.mid)).select("tree_id", "low", F.col("top").alias("high")))
        if longer.isEmpty():
            break
        jumps.append(longer)
    inner = jumps[0].select(F.col("tree_id").alias("t"), F.col("high").alias("n")).distinct()
    leaves = links.join(inner, links.tree_id.eqNullSafe(inner.t) & (links.node_id == inner.n), "left_anti")
    found = leaves.select("tree_id", F.col("node_id").alias("leaf_id"), "node_id", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(jumps))):
        step = jumps[k].select(F.col("tree_id").alias("t"), "low", "high")
        grown = F.filter(
            F.array(
                F.struct(F.col("node_id"), F.col("up")),
                F.struct(F.col("high").alias("node_id"), (F.col("up") + 2**k).alias("up")),
            ),
            lambda x: x["node_id"].isNotNull(),
        )
        found = found.join(step, found.tree_id.eqNullSafe(step.t) & (found.node_id == step.low), "left").select("tree_id", "leaf_id", F.inline(grown))
    # a path below a cycle never ends: it would hold more nodes than its tree has
    roots = links.join(jumps[0].select(F.col("tree_id").alias("t"), "low"), F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("low")), "left_anti")
    ended = found.join(roots.select(F.col("tree_id").alias("t"), F.col("node_id").alias("r")), F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("r")), "left_semi")
    ended = ended.select(F.col("tree_id").alias("t"), F.col("leaf_id").alias("l"))
    return found.join(ended, found.tree_id.eqNullSafe(ended.t) & (found.leaf_id == ended.l), "left_semi")


def choose(found: DataFrame, nodes: DataFrame, best: int) -> DataFrame:
    """The first ``best`` paths of each tree, as (tree_id, leaf_id, path_rank).

    A tree with very many leaves is cut by a salt first; only each salt's best go on.
    """
    score = nodes.select(
        F.col("tree_id").alias("t"),
        F.col("node_id").alias("n"),
        F.when(F.col("score").isNull() | F.isnan("score"), F.lit(float("inf"))).otherwise(-F.col("score")).alias("low_first"),
    )
    keyed = found.join(score, found.tree_id.eqNullSafe(score.t) & (found.node_id == score.n)).groupBy("tree_id", "leaf_id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("o"), "low_first", F.col("n")))).alias("steps")
    )
    key = F.transform("steps", lambda s: F.struct(s["low_first"], s["n"]))
    keyed = keyed.select("tree_id", "leaf_id", key.alias("key"), F.pmod(F.xxhash64("leaf_id"), F.lit(SALTS)).alias("salt"))
    first = Window.partitionBy("tree_id", "salt").orderBy("key")
    last = Window.partitionBy("tree_id").orderBy("key")
    some = keyed.withColumn("r", F.row_number().over(first)).where(F.col("r") <= best)
    return some.withColumn("path_rank", F.row_number().over(last)).where(F.col("path_rank") <= best).select("tree_id", "leaf_id", "path_rank")


def format_trees(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """(tree_id, leaf_id, formatted, loss_spans): one conversation for each path, or for the ``best`` of each tree.

    ``nodes`` has tree_id, node_id, parent_id, role, text, score. ``loss_spans`` are start and end
    of the assistants' texts in the formatted text.
    """
    found = paths(nodes)
    if best is not None:
        top = choose(found, nodes, best).select(F.col("tree_id").alias("t"), F.col("leaf_id").alias("l"))
        found = found.join(top, found.tree_id.eqNullSafe(top.t) & (found.leaf_id == top.l), "left_semi")
    content = nodes.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = found.join(content, found.tree_id.eqNullSafe(content.t) & (found.node_id == content.n)).groupBy("tree_id", "leaf_id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("o"), "role", "text"))).alias("turns")
    )
    tree, leaf = (turns.schema[c].dataType.simpleString() for c in ("tree_id", "leaf_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            done = [render([(t["role"], t["text"]) for t in turns]) for turns in batch.column(2).to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
            columns = [batch.column(0), batch.column(1), pa.array([f for f, _ in done], pa.string()), pa.array(spans, spans_type)]
            yield pa.RecordBatch.from_arrays(columns, ["tree_id", "leaf_id", "formatted", "loss_spans"])

    return map_arrow(turns, run, f"tree_id {tree}, leaf_id {leaf}, formatted string, loss_spans array<struct<start: long, end: long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked text parsed out of the formatted text alone: (tree_id, leaf_id, turns, loss_text)."""
    tree, leaf = (formatted.schema[c].dataType.simpleString() for c in ("tree_id", "leaf_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns_type = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            texts, spans = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            turns = [[{"role": r, "text": t} for r, t in parse(x)] for x in texts]
            loss = [masked(x, [(s["start"], s["end"]) for s in sp]) for x, sp in zip(texts, spans)]
            columns = [batch.column(0), batch.column(1), pa.array(turns, turns_type), pa.array(loss, pa.string()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["tree_id", "leaf_id", "turns", "loss_text", "formatted"])

    src = formatted.select("tree_id", "leaf_id", "formatted", "loss_spans")
    return map_arrow(src, run, f"tree_id {tree}, leaf_id {leaf}, turns array<struct<role: string, text: string>>, loss_text string, formatted string")
