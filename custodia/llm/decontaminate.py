"""Benchmark decontamination: which short test items stand inside which documents.

A size-partitioned MinHash containment search in DataFrame operations only.

* Items are partitioned by the size of their shingle set (powers of two). An item of q shingles is sketched by its k
  smallest shingle hashes with k = q - ceil(t * q) + 1; each size partition has the largest of its
  sketch values as bound.
* A fixed-size sketch of a long document would hardly ever hold a hash of a short item. A document's
  sketch is therefore all its hashes up to a bound: as large as the document needs. A document is too small for a size partition
  if it has fewer than t times the partition's least size; it uses the largest bound of those it can hold.
* A document that holds a share t of an item lacks at most q - ceil(t * q) of its shingles, so one of the k sketch
  values is among them: every true pair becomes a candidate. Candidates are verified by exact containment of the shingle texts.

Words are runs of letters and digits, lower-cased, so punctuation and case hide nothing. Items shorter than
a shingle are one shingle of their own width. Results for odd input: items and documents without words match nothing; null ids are
keys like others; repeated rows are judged row by row (a row is known by id and text) and give one result per distinct id, text and item; empty
tables give empty tables; extra columns of documents are kept by ``clean`` and not read otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import stored

WIDTH = 5
#: Rows up to which a table of hashes or keys (16 to 32 bytes a row) is broadcast; beyond, the join is shuffled.
BROADCAST_ROWS = 500_000


def words(col: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _starts(name: str, width: int) -> Column:
    """First positions of all shingles of this width, counted from 0."""
    n = F.size(name) - width
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def shingle_texts(name: str, width: int) -> Column:
    return F.transform(_starts(name, width), lambda i: F.array_join(F.slice(name, i + 1, width), " "))


def shingle_hashes(name: str, width: int) -> Column:
    """Hashes of shingles, from an array of word hashes."""
    return F.transform(_starts(name, width), lambda i: F.xxhash64(*(F.get(name, i + k) for k in range(width))))


def _bounded(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def _items(items: DataFrame, item_col: str, text_col: str, percent: int) -> DataFrame:
    """One row per item: item, width, texts (distinct shingles), q, need (shingles that make the share)."""
    w = items.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0).distinct()
    width = F.least(F.size("w"), F.lit(WIDTH))
    texts = reduce(lambda out, n: F.when(width == n, shingle_texts("w", n)).otherwise(out), range(1, WIDTH), shingle_texts("w", WIDTH))
    out = w.select("item", width.alias("width"), F.array_distinct(texts).alias("texts"))
    q = F.size("texts")
    return out.withColumn("q", q).withColumn("need", F.ceil(q * percent / 100).cast("int"))


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id, text_key, item, n_item_shingles, n_shared, containment) of every pair with the share or more."""
    known = stored(_items(items, item_col, item_text_col, percent), "items")
    of_words = F.transform(F.split(F.col("t"), " "), lambda x: F.xxhash64(x))
    hashed = known.select("item", "width", "q", "need", F.explode("texts").alias("t")).select("item", "width", "q", "need", shingle_of(of_words).alias("h"))
    smallest = hashed.groupBy("item", "width", "q", "need").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    # the set of an item is bounded by the item's own text
    sketches = smallest.select("item", "width", "need", F.floor(F.log2("q")).cast("int").alias("part"), F.explode(F.slice("hs", F.lit(1), F.col("q") - F.col("need") + 1)).alias("h"))
    sketches = stored(sketches, "sketches")
    parts = sketches.groupBy("width", "part").agg(F.max("h").alias("bound"), F.min("need").alias("least"), F.count("*").alias("n")).collect()  # at most 5 widths x 31 sizes
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    source = src.select("id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w"))
    found = None
    for width in sorted({p["width"] for p in parts}):
        own = [p for p in parts if p["width"] == width]
        n = F.size("wh") - width + 1
        bound = F.greatest(*(F.when(n >= p["least"], F.lit(p["bound"])) for p in own), F.lit(None).cast("long"))
        rows = source.select("id", "text_key", F.transform("w", lambda x: F.xxhash64(x)).alias("wh")).select("id", "text_key", n.alias("n"), bound.alias("bound"), shingle_hashes("wh", width).alias("hs"))
        small = F.array_distinct(F.filter("hs", lambda h: h <= F.col("bound")))
        hits = rows.where("bound is not null").select("id", "text_key", "n", F.explode(small).alias("h"))
        probe = _bounded(sketches.where(F.col("width") == width).select("h", "item", "need"), sum(p["n"] for p in own))
        pairs = hits.join(probe, "h").where("n >= need").select("id", "text_key", "item")
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:  # no item has a word
        none = src.select("id", F.lit(0).cast("long").alias("text_key"))
        return none.crossJoin(known.select("item").limit(0)).select("id", "text_key", "item", F.lit(0).cast("long").alias("n_item_shingles"), F.lit(0).cast("long").alias("n_shared"), F.lit(0.0).alias("containment")).limit(0)
    candidates = stored(found.distinct(), "candidates")
    return _verified(src, candidates, known)


def shingle_of(word_hashes: Column) -> Column:
    """Hash of one whole shingle, equal to ``shingle_hashes`` of its words at any width."""
    n = F.size(word_hashes)
    return reduce(lambda out, k: F.when(n == k, F.xxhash64(*(F.get(word_hashes, F.lit(i)) for i in range(k)))).otherwise(out), range(1, WIDTH), F.xxhash64(*(F.get(word_hashes, F.lit(i)) for i in range(WIDTH))))


def _verified(src: DataFrame, candidates: DataFrame, known: DataFrame) -> DataFrame:
    keys = candidates.select(F.col("id").alias("i"), F.col("text_key").alias("k")).distinct()
    n_keys, n_known = candidates.count(), known.agg(F.coalesce(F.sum("q"), F.lit(0))).first()[0]
    keyed = src.select("id", F.xxhash64("text").alias("text_key"), "text")
    near = keyed.join(_bounded(keys, n_keys), keyed.id.eqNullSafe(keys.i) & (keyed.text_key == keys.k), "left_semi").distinct()
    found = None
    for width in range(1, WIDTH + 1):
        part = near.select("id", "text_key", words(F.col("text")).alias("w")).select("id", "text_key", F.explode(F.array_distinct(shingle_texts("w", width))).alias("t"))
        texts = known.where(F.col("width") == width).select("item", "q", "need", F.explode("texts").alias("t"))
        hits = part.join(_bounded(texts, n_known), "t").select("id", "text_key", "item", "q", "need")
        found = hits if found is None else found.unionByName(hits)
    counts = found.groupBy("id", "text_key", "item", "q", "need").agg(F.count("*").alias("n_shared")).where("n_shared >= need")
    c = candidates.select(F.col("id").alias("i"), F.col("text_key").alias("k"), F.col("item").alias("m"))
    sure = counts.join(_bounded(c, n_keys), counts.id.eqNullSafe(c.i) & (counts.text_key == c.k) & counts.item.eqNullSafe(c.m), "left_semi")
    return sure.select("id", "text_key", "item", F.col("q").cast("long").alias("n_item_shingles"), "n_shared", (F.col("n_shared") / F.col("q")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    hits = stored(contained(docs, items, id_col, text_col, item_col, item_text_col, percent).select(F.col("id").alias("__i"), F.col("text_key").alias("__k")).distinct(), "hits")
    return docs.join(_bounded(hits, hits.count()), F.col(id_col).eqNullSafe(F.col("__i")) & (F.xxhash64(F.col(text_col)) == F.col("__k")), "left_anti")
