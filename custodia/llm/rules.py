"""Quality rules: base counts of a text, and a verdict by a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word and symbol n-grams (one and two tokens) are counted, one over
trusted documents, one over the raw corpus, both over whole texts. A document's score is the mean
of log(p_trusted / p_raw) over its n-grams; it is kept if that mean reaches a fixed threshold.
Nothing is sampled at random: the same text always gets the same verdict.

The counts are bounded by the number of buckets whatever the corpus, so they are summed in Spark and
the two vectors travel to the tasks as constants. Every trusted document (``trusted_ids`` of ``fit``) and every raw one is
counted, however many there are.

Results for odd input: null and empty texts have zero counts, a score of 0 and fail the base rule. An
empty corpus gives equal multinomials (every score 0). Repeated rows count as often as they stand.
Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from custodia.llm.common import Cache, hash_cache, hashes, map_arrow, mixed, raw_words, texts, windows

BUCKETS = 1 << 16
#: Share of the raw multinomial that is mixed into the trusted one, so that no ratio is below its logarithm.
SMOOTHING = 0.01
#: Kept from this mean log-ratio on (natural logarithm).
THRESHOLD = -0.1
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
_TOKEN = re.compile(r"\w+|[^\w\s]")


def base_counts(text: str | None, cache: Cache) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = raw_words(text)
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeated = 0
    if len(words) > 3:
        _, inverse, counts = np.unique(windows(hashes(words, cache), 3), return_inverse=True, return_counts=True)
        often = counts[inverse] > 1
        cover = np.zeros(len(words), bool)
        for i in range(3):
            cover[i : i + len(often)] |= often
        repeated = int(cover.sum())
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > 50 * n_words


def token_cache() -> Cache:
    return Cache(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")))


def buckets(text: str | None, cache: Cache, n: int = BUCKETS) -> np.ndarray:
    """Buckets of all one- and two-token n-grams, in order of size."""
    tokens = _TOKEN.findall(text) if text else []
    h = np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))
    both = np.concatenate((mixed(h), windows(h, 2)))
    return (both % np.uint64(n)).astype(np.int64)


@dataclass(frozen=True)
class Ratio:
    """Log-ratio per bucket."""

    weights: np.ndarray

    def score(self, text: str | None, cache: Cache) -> float:
        b = buckets(text, cache, len(self.weights))
        return float(self.weights[b].mean()) if len(b) else 0.0


def ratio(trusted: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> Ratio:
    if not trusted.sum():
        return Ratio(np.zeros(len(raw)))
    t, r = trusted / trusted.sum(), raw / raw.sum()
    unseen = raw == 0  # no evidence either way
    return Ratio(np.where(unseen, 0, np.log((1 - smoothing) * t + smoothing * r + unseen) - np.log(r + unseen)))


def fit(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = BUCKETS) -> Ratio:
    """Count both multinomials; ``trusted_ids`` may be of any number.

    Texts are read once and never shuffled: what meets the trusted ids, in one sort-merge join at all sizes, is each document's
    n-grams as packed bucket numbers of two bytes.
    """
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("id")).where("id is not null").distinct().withColumn("trusted", F.lit(True))
    width = np.uint16 if n <= 1 << 16 else np.uint32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = token_cache()
        for batch in batches:
            grams = [np.sort(buckets(t, cache, n)).astype(width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], ["id", "grams"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    packed = map_arrow(src, pack, StructType([src.schema["id"], *StructType.fromDDL("grams binary").fields]))
    marked = packed.join(ids.hint("merge"), "id", "left").select("grams", "trusted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trusted, raw = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for grams, mark in texts(batches, "grams", "trusted"):
            raw += np.bincount(np.frombuffer(b"".join(grams), width), minlength=n)
            trusted += np.bincount(np.frombuffer(b"".join(g for g, m in zip(grams, mark) if m), width), minlength=n)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": seen.astype(np.int32), "trusted": trusted[seen], "raw": raw[seen]})

    parts = map_arrow(marked, run, "bucket int, trusted long, raw long")
    sums = parts.groupBy("bucket").agg(F.sum("trusted").alias("trusted"), F.sum("raw").alias("raw")).toPandas()  # at most n rows
    trusted, raw = np.zeros(n), np.zeros(n)
    trusted[sums["bucket"]], raw[sums["bucket"]] = sums["trusted"], sums["raw"]
    return ratio(trusted, raw)


def apply(docs: DataFrame, model: Ratio, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, the base counts, base_failed, the mean log-ratio and the verdict."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tokens = hash_cache(), token_cache()
        for batch in batches:
            rows = batch.column(1).to_pylist()
            counts = [base_counts(t, words) for t in rows]
            failed = [base_failed(c[0], c[4]) for c in counts]
            score = [model.score(t, tokens) for t in rows]
            kept = [not f and s >= threshold for f, s in zip(failed, score)]
            columns = [batch.column(0), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(5)), pa.array(failed, pa.bool_()), pa.array(score, pa.float64()), pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, *names, "base_failed", "score", "kept"])

    schema = f"`{id_col}` {id_type}, {', '.join(f'{c} long' for c in names)}, base_failed boolean, score double, kept boolean"
    return map_arrow(docs.select(id_col, text_col), run, schema)
