"""Near-duplicate documents: universal-hash minima, banding, verification, connected components.

1. Each document's set of word shingles is hashed once and sketched: 128 minima of universal hashes
   (a*x + b mod 2^64), folded into 32 band keys of four minima, and one byte of each minimum as signature.
   Two sets with similarity 0.8 share no band with probability 5e-8.
2. Documents with the same set are one node, the smallest id; copies never meet each other.
3. Every bucket of a band offers one node as partner of all others (linear in the bucket): the one whose buckets hold
   most nodes in all, which is the common original where copies differ from one text. Each
   node is compared with the partner it shares most bands with, on full sets.
   Signatures that agree too seldom (five standard deviations below the threshold) spare the comparison.
4. Connected components of these links. A bucket whose nodes are in one component is settled. The nodes of all
   other buckets are compared with one another across components, in blocks, by signature and on full sets (``rest_links``). So no
   bucket is capped, no link between different texts is given up, and only links leave a block.
5. Components of all links, mapped back to every document.

Results for odd input: null, empty and word-less texts have no shingles and are linked with nothing; texts with
fewer words than a shingle are one shingle. Rows with a null id are returned with a null component and kept. Repeated
ids are one node: it has the links of all its texts. Empty tables give empty tables. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import Cache, dropped, hash_cache, hashes, lower_words, map_arrow, mixed, stored, windows
from custodia.llm.components import components

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
_RNG = np.random.default_rng(20_240_801)
_A = _RNG.integers(0, 2**64, HASHES, np.uint64, endpoint=False) | np.uint64(1)
_B = _RNG.integers(0, 2**64, HASHES, np.uint64, endpoint=False)
#: Shingles hashed at a time; bounds the work matrix.
CHUNK = 1024
#: Shingles of a block; two blocks meet at a time. Bounds a cell's memory whatever the texts' lengths.
BLOCK = 400_000
#: Members verified against one copy of their partner's text; larger groups are salted.
SALT_ROWS = 2000


def shingles(text: str | None, cache: Cache, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of n words."""
    h = hashes(lower_words(text), cache)
    if not len(h):
        return h
    if len(h) < n:
        return mixed(windows(h, len(h)) + np.uint64(len(h)))
    return np.unique(windows(h, n))


def minima(x: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(x), CHUNK):
        np.minimum(out, (np.multiply.outer(_A, x[i : i + CHUNK]) + _B[:, None]).min(axis=1), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    rows = m.reshape(BANDS, ROWS)
    key = np.zeros(BANDS, np.uint64)
    for i in range(ROWS):
        key = mixed(key + rows[:, i] + np.uint64(i + 1))
    return key.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b| for sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum()) if len(large) else 0
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, n_shingles, set_key, bands, signature) per row; bands and signature are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = hash_cache()
        for batch in batches:
            sizes, keys, bands, signs = [], [], [], []
            for text in batch.column(1).to_pylist():
                x = shingles(text, cache, n)
                sizes.append(len(x))
                keys.append(xxhash.xxh3_128_digest(x.tobytes()))
                m = minima(x) if len(x) else None
                bands.append(None if m is None else band_keys(m))
                signs.append(None if m is None else (mixed(m) >> np.uint64(56)).astype(np.uint8).tobytes())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "set_key", "bands", "signature"])

    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(src, run, f"id {id_type}, n_shingles long, set_key binary, bands array<long>, signature binary")


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Members follow their partner's text within a sorted partition; a partner with many members is
    given to several partitions, so no group has to fit one task.
    """
    id_type = texts.schema["id"].dataType.simpleString()
    parts = F.ceil(F.count("*") / SALT_ROWS).cast("int")
    sizes = pairs.groupBy("a").agg(parts.alias("parts"))
    members = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"), F.lit(1).alias("side"), F.col("b").alias("id")).join(texts, "id")
    heads = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("a").alias("id")).join(texts, "id")
    order = ["a", "salt", "side", "id"]
    dealt = members.select(*order, "text").unionByName(heads.select(*order, "text")).repartition("a", "salt").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key, partner = hash_cache(), None, []
        for batch in batches:
            a, b = [], []
            for x, salt, side, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (x, salt):
                    key, partner = (x, salt), []
                if side == 0:
                    partner.append(shingles(text, cache, n))
                    continue
                own = shingles(text, cache, n)
                if len(own) and any(len(p) and similar(p, own, percent) for p in partner):
                    a.append(x)
                    b.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field(0).type), pa.array(b, batch.schema.field(3).type)], ["u", "v"])

    return map_arrow(dealt, run, f"u {id_type}, v {id_type}")


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree as often as a similar pair's do, up to five standard deviations."""
    t = percent / 100
    least = int(np.floor(HASHES * (t - 5 * np.sqrt(t * (1 - t) / HASHES))))
    id_type = nodes.schema["id"].dataType.simpleString()
    of = {x: nodes.select(F.col("id").alias(x), F.col("signature").alias(f"sign_{x}")) for x in "ab"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    signed = pairs.join(of["a"], "a").join(of["b"], "b").select("a", "b", "sign_a", "sign_b")
    return map_arrow(signed, run, f"a {id_type}, b {id_type}")


def _links_in_block(rows: list[tuple], n: int, percent: int, least: int, cache: Cache) -> list[tuple]:
    """Links between components among the rows (id, component, side, text) of one cell, as few as join them."""
    sets = [shingles(r[3], cache, n) for r in rows]
    signs = np.stack([(mixed(minima(x)) >> np.uint64(56)).astype(np.uint8) for x in sets])
    sizes, side = np.array([len(x) for x in sets]), np.array([r[2] for r in rows])
    names = {c: k for k, c in enumerate(dict.fromkeys(r[1] for r in rows))}
    group = np.array([names[r[1]] for r in rows])  # merged as links are found
    out = []
    for i in np.flatnonzero(side == 0):
        later = np.arange(len(rows)) > i if side.max() == 0 else side == 1
        able = later & (group != group[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        others = np.flatnonzero(able)
        for j in others[(signs[others] == signs[i]).sum(axis=1) >= least]:
            if group[j] != group[i] and similar(sets[i], sets[j], percent):
                out.append((rows[i][0], rows[j][0]))
                group[group == group[j]] = group[i]
    return out


def rest_links(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(u, v), stored: the links between components among nodes of buckets that hold several components.

    Buckets that have nodes in common form a family. A family is cut into blocks, and every two blocks of it meet in one
    cell with their texts; there, signatures and then full sets are compared, and only links come out, at most one
    less than the cell's nodes. A family's size never makes rows of pairs nor a large task.
    """
    tagged = buckets.join(labels, buckets.id == labels.node, "left").select("band", "key", "id", F.coalesce("component", "id").alias("component"))
    open_ = tagged.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("first")).where("low <> high").drop("low", "high")
    contested = stored(tagged.join(open_, ["band", "key"]).select("first", "id", "component").distinct(), "contested")
    families = components(contested, "first", "id").select(F.col("node").alias("id"), F.col("component").alias("family"))
    blocks = F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("blocks")
    sizes = families.join(nodes.select("id", "n_shingles"), "id").groupBy("family").agg(blocks)
    members = contested.select("id", "component").distinct().join(families, "id").join(sizes, "family")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cell = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda r: F.struct(F.least(r, F.col("own")).alias("x"), F.greatest(r, F.col("own")).alias("y"), (r < F.col("own")).cast("int").alias("side")))
    cells = members.withColumn("own", own).select("family", "id", "component", F.inline(cell))
    id_type = texts.schema["id"].dataType.simpleString()
    order = ["family", "x", "y", "side", "id"]
    dealt = cells.join(texts, "id").select(*order, "component", "text").repartition("family", "x", "y").sortWithinPartitions(*order)
    t = percent / 100
    least = int(np.floor(HASHES * (t - 5 * np.sqrt(t * (1 - t) / HASHES))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, key, held, kind = hash_cache(), None, [], None

        def links() -> pa.RecordBatch:
            found = _links_in_block(held, n, percent, least, cache) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], kind), pa.array([b for _, b in found], kind)], ["u", "v"])

        for batch in batches:
            kind = batch.schema.field(4).type
            for family, x, y, side, node, component, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (family, x, y):
                    if held:
                        yield links()
                    key, held = (family, x, y), []
                held.append((node, component, side, text))
        if held:
            yield links()

    found = stored(map_arrow(dealt, run, f"u {id_type}, v {id_type}"), "more")
    dropped(contested)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable over links) and kept (it is that id).

    A link is a pair with at least ``percent`` per cent of the union of their n-word shingles in common.
    """
    rows = stored(sketch(docs, id_col, text_col, n), "sketch")
    known = rows.where("n_shingles > 0 and id is not null")
    nodes = known.groupBy("set_key").agg(F.min(F.struct("id", "bands", "signature", "n_shingles")).alias("s")).select("set_key", "s.*")
    nodes = stored(nodes, "nodes")
    # the sketches have done their part: what is left of them is small
    sketched, rows = rows, stored(rows.select("id", "n_shingles", "set_key"), "sets")
    known = rows.where("n_shingles > 0 and id is not null")
    dropped(sketched)
    in_bands = nodes.select("id", F.posexplode("bands").alias("band", "key"))
    sizes = in_bands.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(in_bands.join(sizes, ["band", "key"]), "shared")
    popular = shared.groupBy("id").agg(F.sum("n").alias("met"))
    leaders = shared.join(popular, "id").groupBy("band", "key").agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("leader"))
    buckets = stored(shared.join(leaders, ["band", "key"]).drop("n"), "buckets")
    dropped(shared)
    met = buckets.select("id").distinct()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = stored(src.join(met, "id", "left_semi"), "texts")
    best = buckets.where("id <> leader").groupBy("leader", "id").count().groupBy("id").agg(F.max_by("leader", F.struct("count", -F.col("leader"))).alias("a"))
    pairs = stored(plausible(best.select("a", F.col("id").alias("b")), nodes, percent), "pairs")
    first = confirmed(pairs, texts, n, percent)
    # an id that stands with several texts ties their nodes together
    of_id = known.select("id", "set_key").distinct().join(nodes.select("set_key", F.col("id").alias("node")), "set_key")
    several = of_id.groupBy("id").agg(F.min("node").alias("u"), F.max("node").alias("top")).where("u <> top").select("id", "u")
    tied = of_id.join(several, "id").select("u", F.col("node").alias("v"))
    links = stored(first.unionByName(tied), "links")
    dropped(pairs)
    labels = components(links)
    more = rest_links(buckets.select("band", "key", "id"), labels, nodes, texts, n, percent)
    stars = labels.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u <> v")
    final = components(stars.unionByName(more))
    component = stored(nodes.join(final, nodes.id == final.node, "left").select("set_key", F.coalesce("component", "id").alias("component")), "components")
    for scratch in (nodes, buckets, texts, links, more):
        dropped(scratch)
    out = rows.select("id", "n_shingles", "set_key").join(component, "set_key", "left")
    alone = F.col("id").isNull() | (F.col("n_shingles") == 0)
    shown = F.when(alone, F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), "n_shingles", shown.alias("component_id"), F.coalesce(F.col("id") == shown, F.lit(True)).alias("kept"))
