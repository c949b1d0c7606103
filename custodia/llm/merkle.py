"""Merkle dataset manifest with a witness for every row.

Rows are leaves, ordered within their group; sixteen consecutive nodes become one, level by level, until one is left: the group's
subroot. The subroots, ordered by group, are the leaves of one more tree, whose top is the root of the table.

Each tree grows by streaming appends. A run of up to sixteen siblings stays open while it fills; a node that is appended gets its place in the
open run at once, which is its partial witness, and every sibling that is completed later extends that run and so the witnesses of
all leaves below it. A block of 16^3 aligned leaves is appended within one task; blocks of one group lie in different tasks, so a group
with a third of all rows is spread. The roots of the blocks are further appends, in blocks of their own, until a group has one block. On the way down a block's own witness
comes first in the stream of its leaves, whose witnesses end with it.

Odd inputs: a null field is ``-``, an empty text ``0:``; a null group is a group of its own, before all others; null ids come first;
rows of one id follow each other by their leaf, so exact copies are leaves of their own and the tree does not depend on how ties are dealt.
A lone leaf is its group's subroot and has no siblings there. An empty table gives an empty manifest. Other columns of the table are
not read, and what is carried along stands in one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from custodia.llm.common import dropped, map_arrow, stored

ARITY = 16
#: Levels of a block: 16^3 leaves are appended in one task.
BLOCK_LEVELS = 3
BLOCK = ARITY**BLOCK_LEVELS
#: Rows of one Arrow batch of witnesses, about 1 KB a level and row.
ROWS_OUT = 1024

WITNESS = "array<struct<siblings:string,slot:int>>"
_SPOT = pa.struct([("siblings", pa.string()), ("slot", pa.int32())])


def encoded(col: str | Column) -> Column:
    """A field so that no two lists of fields read alike: ``-`` if null, else its length in bytes and itself."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: str | Column) -> Column:
    return F.sha2(F.concat(*(encoded(c) for c in fields)), 256)


def proof(witness: str | Column) -> Column:
    """One digest of all siblings from the leaf up to the root."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: s["siblings"]), ""), 256)


def folded(digest: str | Column, witness: str | Column) -> Column:
    """The root that a leaf and its witness lead to."""
    width = 64

    def up(below, spot):
        before = spot["slot"] * width
        left = spot["siblings"].substr(F.lit(1), before)
        right = spot["siblings"].substr(before + 1, F.length(spot["siblings"]))
        return F.sha2(F.concat(left, below, right), 256)

    return F.aggregate(witness, F.col(digest) if isinstance(digest, str) else digest, up)


def digest_of(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


class Run:
    """Siblings under one parent, open until it has all of them; its nodes' witnesses refer to it."""

    __slots__ = ("digests", "parent", "slot", "joined", "above")

    def __init__(self):
        self.digests: list[str] = []
        self.parent: Run | None = None  # the run its own node stands in, and where; none above a block's root
        self.slot = 0
        self.joined: str | None = None
        self.above: tuple[list[str], list[int]] | None = None

    def upper(self) -> tuple[list[str], list[int]]:
        """Siblings and places above this run, the same for all its members."""
        if self.above is None:
            self.above = self.parent.witness(self.slot)
        return self.above

    def witness(self, slot: int) -> tuple[list[str], list[int]]:
        """Siblings and places from one member upwards."""
        siblings, slots = self.upper()
        if self.parent is None:
            return siblings, slots
        others = self.joined[: 64 * slot] + self.joined[64 * slot + 64 :]
        return [others, *siblings], [slot, *slots]


class Subtree:
    """Streaming append to the open subtrees of one block."""

    def __init__(self, levels: int):
        self.levels = levels
        self.open = [Run() for _ in range(levels + 1)]

    def append(self, digest: str, level: int = 0, below: Run | None = None) -> tuple[Run, int]:
        """Where the node stands: its partial witness, extended by each sibling that is completed later."""
        run = self.open[level]
        slot = len(run.digests)
        run.digests.append(digest)
        if below is not None:
            below.parent, below.slot = run, slot
        if level < self.levels and slot + 1 == ARITY:
            self.complete(level)
        return run, slot

    def complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], Run()
        run.joined = "".join(run.digests)
        self.append(digest_of(run.joined), level + 1, run)

    def finish(self, above: tuple[list[str], list[int]] = ([], [])) -> str:
        """Close the runs that are still open and put the block's own witness on top; the block's root."""
        for level in range(self.levels):
            if self.open[level].digests:
                self.complete(level)
        top = self.open[self.levels]
        top.above = above
        return top.digests[0]


def levels_of(n: int) -> int:
    """Levels of the blocks of a group of n nodes: up to one node if one block holds them all, whole blocks otherwise."""
    if n > BLOCK:
        return BLOCK_LEVELS
    levels = 0
    while ARITY**levels < n:
        levels += 1
    return levels


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables that end where a block ends, with the row at which each of their blocks starts."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        keys = list(zip(rows["k"].to_pylist(), rows["block"].to_pylist()))
        starts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        if starts[-1]:
            yield rows.slice(0, starts[-1]), starts[:-1]
        rest = rows.slice(starts[-1])
    if rest is not None:
        yield rest, [0]


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in _whole_blocks(batches):
        digests, keys, blocks, n = (rows[c].to_pylist() for c in ("digest", "k", "block", "n"))
        tops = []
        for first, end in zip(starts, [*starts[1:], len(digests)]):
            tree = Subtree(levels_of(n[first]))
            for d in digests[first:end]:
                tree.append(d)
            tops.append(tree.finish())
        yield pa.RecordBatch.from_pydict(
            {
                "k": pa.array([keys[i] for i in starts], pa.string()),
                "pos": pa.array([blocks[i] for i in starts], pa.int64()),
                "n": pa.array([-(-n[i] // BLOCK) for i in starts], pa.int64()),
                "digest": pa.array(tops, pa.string()),
            }
        )


def _witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks whose first row is the block's own witness; every other row gets its own."""
    for rows, starts in _whole_blocks(batches):
        digests, n = rows["digest"].to_pylist(), rows["n"].to_pylist()
        keep, spots, tops = [], [], []
        for first, end in zip(starts, [*starts[1:], len(digests)]):
            if end == first + 1:
                raise ValueError("a block without leaves")
            above = rows["above"][first].as_py()
            tree = Subtree(levels_of(n[first + 1]))
            spots += [tree.append(d) for d in digests[first + 1 : end]]
            tree.finish(([s["siblings"] for s in above["witness"]], [s["slot"] for s in above["witness"]]))
            keep.extend(range(first + 1, end))
            tops.extend([(above["subroot"], above["root"])] * (end - first - 1))
        passed = rows.select(["id", "k", "pos", "digest", "carried"]).take(pa.array(keep, pa.int64()))
        for at in range(0, len(keep), ROWS_OUT):
            siblings, slots, ends = [], [], [0]
            for run, slot in spots[at : at + ROWS_OUT]:
                up = run.witness(slot)
                siblings += up[0]
                slots += up[1]
                ends.append(len(slots))
            some = passed.slice(at, ROWS_OUT).combine_chunks()
            witness = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(siblings, pa.string()), pa.array(slots, pa.int32())], fields=list(_SPOT)))
            columns = {c: some[c].chunk(0) if some[c].num_chunks else pa.array([], some[c].type) for c in some.column_names}
            sub, root = zip(*tops[at : at + ROWS_OUT])
            yield pa.RecordBatch.from_pydict({**columns, "witness": witness, "subroot": pa.array(sub, pa.string()), "root": pa.array(root, pa.string())})


def _numbered(nodes: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """Nodes with their place ``pos`` among the ``n`` of their group, and the table to drop when they have been used.

    A group spans many sorted partitions; small totals of (group, partition) say how many came before.
    """
    by = ["k", *order]
    parts = stored(
        nodes.repartitionByRange(*by).sortWithinPartitions(*by).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "merkle-sorted",
    )
    runs = parts.groupBy("k", "part").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    before = F.sum("here").over(W.partitionBy("k").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("here")
    runs = runs.select("k", "part", (before - F.col("first")).alias("shift"), F.sum("here").over(W.partitionBy("k")).alias("n"))
    placed = parts.join(runs, ["k", "part"]).withColumn("pos", F.col("shift") + F.col("at")).drop("part", "at", "shift")
    return placed, parts


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Aligned blocks, each whole within a partition and in order; the block's own row (pos -1) first."""
    return nodes.repartition("k", "block").sortWithinPartitions("k", "block", "pos")


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).cast("long")


def _upwards(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Stored roots of the blocks, layer by layer, until every group has one block; ``most`` is the size of the largest group."""
    layers = []
    while True:
        plain = nodes.select("k", "pos", "n", "digest", _block().alias("block"))
        roots = stored(map_arrow(_in_blocks(plain), _roots, "k string, pos long, n long, digest string"), "merkle-roots")
        layers.append(roots)
        if most <= BLOCK:
            return layers
        most = -(-most // BLOCK)
        nodes = roots.where("n > 1")


def _downwards(nodes: DataFrame, layers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Witnesses of the nodes: those within their block and, after them, those of the block; ``tops`` holds (k, above) per group."""
    above = None
    for i in range(len(layers) - 1, -1, -1):
        # groups that end at this layer take the witness of their subroot
        ends = layers[i].where("n = 1").select("k", F.col("pos").alias("block")).join(tops, "k")
        above = ends if above is None else above.unionByName(ends)
        last = i == 0
        below = nodes if last else layers[i - 1].where("n > 1").select("*", F.lit(None).cast("long").alias("id"), F.lit(None).cast("int").alias("carried"))
        below = below.select("id", "k", "pos", "n", "digest", "carried", _block().alias("block"))
        both = below.unionByName(above.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        passed = below.select("id", "k", "pos", "digest", "carried").schema.fields
        out = StructType(passed + StructType.fromDDL(f"witness {WITNESS}, subroot string, root string").fields)
        done = map_arrow(_in_blocks(both), _witnesses, out)
        if last:
            return done
        above = done.select("k", F.col("pos").alias("block"), F.struct("witness", "subroot", "root").alias("above"))
    raise AssertionError("a tree has a layer")


def manifest(df: DataFrame, id_col: str, fields: list[str], group: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """id, k, pos, leaf, subroot, root, witness and the struct ``carried`` of every row.

    ``fields`` make the leaf, in their order. ``group`` names the column of the subtrees, ordered bytewise as text; ``k`` is it with
    ``+`` before it, or empty for null, and ``pos`` the leaf's place in the group. ``witness`` lists, from the leaf up to the
    root, the joined digests of the other members of its run and its own place among them: with ``folded`` it leads from the
    leaf to the root. ``carry`` names further columns to keep.
    """
    carried = F.struct(*(c.alias(name) for name, c in carry.items())) if carry else F.lit(None).cast("int")
    k = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    narrow = stored(df.select(k.alias("k"), F.col(id_col).alias("id"), leaf(*fields).alias("digest"), carried.alias("carried")), "merkle-leaves")
    nodes, scratch = _numbered(narrow, "id", "digest")
    dropped(narrow)
    most = nodes.agg(F.max("n")).first()[0] or 0
    layers = _upwards(nodes, most)

    subroots = layers[0].where("n = 1")
    for layer in layers[1:]:
        subroots = subroots.unionByName(layer.where("n = 1"))
    # the subroots are leaves of the last tree, one group of its own
    leaves = subroots.select(F.lit("").alias("k"), F.col("k").alias("id"), "digest", F.lit(None).cast("int").alias("carried"))
    top_nodes, _ = _numbered(leaves, "id")
    top_layers = _upwards(top_nodes, top_nodes.agg(F.max("n")).first()[0] or 0)
    nothing = F.lit([]).cast(WITNESS)
    root = top_layers[-1].where("n = 1").select("k", F.struct(nothing.alias("witness"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root")).alias("above"))
    topped = _downwards(top_nodes, top_layers, root)
    tops = stored(topped.select(F.col("id").alias("k"), F.struct("witness", F.col("digest").alias("subroot"), "root").alias("above")), "merkle-tops")
    return _downwards(nodes, layers, tops).withColumnRenamed("digest", "leaf")
