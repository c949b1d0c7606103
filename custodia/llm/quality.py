"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every token has a sparse index vector fixed by its hash (one +1 and one -1 among ``DIMS``). A pass over the whole corpus adds to
each token the index vectors of its neighbours up to two places away; tokens share ``BUCKETS`` rows, so the sums are
bounded whatever the corpus and are added up in Spark. A document is the mean and the spread of its tokens' vectors and the
mean step between neighbours. A network with one hidden layer, written in numpy, is fitted to a bounded sample of
labelled documents (``MAX_LABELLED``), and a temperature chosen on a part kept aside makes its outputs probabilities.

Results for odd input: null and empty texts pool to zeros and get the score of that vector; without labelled rows of
both classes every score is the share of the one that is there, or 0.5; repeated rows are scored one by one; extra columns are kept and not read.
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
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from custodia.llm.common import Cache, chosen_ids, map_arrow, texts

BUCKETS, DIMS, REACH = 1 << 15, 32, 2
MAX_LABELLED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 40, 256, 3e-3, 1e-4, 7
#: Tokens whose sums are gathered at a time.
CHUNK = 200_000
_TOKEN = re.compile(r"\w+|[^\w\s]")


def token_cache(n: int = BUCKETS) -> Cache:
    return Cache(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) % n)


def token_buckets(text: str | None, cache: Cache) -> np.ndarray:
    tokens = _TOKEN.findall(text) if text else []
    return np.fromiter(map(cache.__getitem__, tokens), np.int32, len(tokens))


def index_vectors(n: int = BUCKETS, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Places of +1 and -1 of each bucket's index vector."""
    rng = np.random.default_rng(SEED)
    plus = rng.integers(0, dims, n)
    return plus, (plus + rng.integers(1, dims, n)) % dims


def context_sums(docs: list[np.ndarray], n: int = BUCKETS, dims: int = DIMS) -> np.ndarray:
    """Sum of the index vectors of all neighbours, per bucket."""
    plus, minus = index_vectors(n, dims)
    out = np.zeros(n * dims)
    # REACH empty places between documents keep neighbours apart
    gap = np.full(REACH, -1, np.int64)
    flat = np.concatenate([x for d in docs for x in (d.astype(np.int64), gap)]) if docs else np.zeros(0, np.int64)
    for offset in range(1, REACH + 1):
        a, b = flat[:-offset], flat[offset:]
        ok = (a >= 0) & (b >= 0)
        a, b = a[ok], b[ok]
        for own, other in ((a, b), (b, a)):
            at = own * dims
            out += np.bincount(at + plus[other], minlength=n * dims)
            out -= np.bincount(at + minus[other], minlength=n * dims)
    return out.reshape(n, dims)


def word_vectors(docs: DataFrame, text_col: str = "text", n: int = BUCKETS, dims: int = DIMS) -> np.ndarray:
    """Context vectors over all documents, scaled to length one."""
    names = [f"c{i}" for i in range(dims)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, total, held, size = token_cache(n), np.zeros((n, dims)), [], 0
        for (text,) in texts(batches, "text"):
            for t in text:
                held.append(token_buckets(t, cache))
                size += len(held[-1])
                if size >= CHUNK:
                    total += context_sums(held, n, dims)
                    held, size = [], 0
        total += context_sums(held, n, dims)
        seen = np.flatnonzero(np.abs(total).any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), *(pa.array(total[seen, i]) for i in range(dims))], ["bucket", *names])

    src = docs.select(F.col(text_col).alias("text"))
    parts = map_arrow(src, run, "bucket int, " + ", ".join(f"{c} double" for c in names))
    sums = parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names)).toPandas()  # at most n rows
    out = np.zeros((n, dims), np.float32)
    values = sums[names].to_numpy()
    out[sums["bucket"]] = values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-9)
    return out


def pooled(text: str | None, vectors: np.ndarray, cache: Cache) -> np.ndarray:
    """Mean, spread and mean step of the token vectors: three times DIMS values."""
    ids, dims = token_buckets(text, cache), vectors.shape[1]
    if not len(ids):
        return np.zeros(3 * dims, np.float32)
    total, square, step, before = np.zeros(dims), np.zeros(dims), np.zeros(dims), None
    for i in range(0, len(ids), CHUNK):
        v = vectors[ids[i : i + CHUNK]]
        total += v.sum(axis=0)
        square += np.einsum("ij,ij->j", v, v)
        step += np.abs(np.diff(v, axis=0)).sum(axis=0) + (0 if before is None else np.abs(v[0] - before))
        before = v[-1]
    mean = total / len(ids)
    spread = np.sqrt(np.maximum(square / len(ids) - mean * mean, 0))
    return np.concatenate((mean, spread, step / max(1, len(ids) - 1))).astype(np.float32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass(frozen=True)
class Network:
    """Standardisation, two layers and a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.centre) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the logistic loss, then the temperature with the least loss on every fifth row."""
    x, y = x.astype(float), y.astype(float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        z = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return Network(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros(1), z)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    aside = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(SEED)
    z, t = ((x - centre) / scale)[~aside], y[~aside]
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(t))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            h = np.tanh(z[rows] @ params[0] + params[1])
            d = (sigmoid(h @ params[2] + params[3]) - t[rows]) / len(rows)
            back = np.outer(d, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + DECAY * params[0], back.sum(axis=0), h.T @ d + DECAY * params[2], np.array([d.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] = params[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, scale, params[0], params[1], params[2], float(params[3][0]))
    if not aside.any():
        return net
    raw, truth = net.logits(x[aside]), y[aside]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, np.where(truth > 0, -raw, raw) / t)) for t in grid]
    return Network(centre, scale, *params[:3], float(params[3][0]), float(grid[int(np.argmin(loss))]))


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> Model:
    """Vectors from all of ``docs``; the network from at most ``max_labelled`` rows of ``labelled`` (id, label 0 or 1)."""
    spark, (lid, label) = docs.sparkSession, labelled.columns[:2]
    vectors = word_vectors(docs, text_col)
    known = labelled.where(F.col(label).isin(0, 1)).groupBy(lid).agg(F.max(label).cast("int").alias("y"))
    picked = known.orderBy(F.xxhash64(lid, F.lit(SEED)), lid).limit(max_labelled).collect()
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = spark.createDataFrame([(r[0], r[1]) for r in picked], f"__id {id_type}, y int")
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(rows), "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = token_cache(len(vectors))
        for text, y in texts(batches, "text", "y"):
            x = [pooled(t, vectors, cache) for t in text]
            yield pa.RecordBatch.from_pydict({"y": pa.array(y, pa.int32()), "x": pa.array(x, pa.list_(pa.float32()))})

    data = map_arrow(sample.select("text", "y"), run, "y int, x array<float>").toPandas()
    x = np.stack([*data["x"], np.zeros(3 * vectors.shape[1], np.float32)])[:-1]
    y = data["y"].to_numpy(float)
    order = np.lexsort([*x.T[:3], y])  # the same order in every run
    order = order[np.random.default_rng(SEED).permutation(len(order))]
    return Model(vectors, train(x[order], y[order]))


def apply(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """All columns of ``docs`` plus ``__score`` and ``__predicted``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = token_cache(len(model.vectors))
        for batch in batches:
            x = [pooled(t, model.vectors, cache) for t in batch.column(at).to_pylist()]
            score = model.network.scores(np.stack(x)) if x else np.zeros(0)
            columns = [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "__score", "__predicted"])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField("__score", DoubleType()), StructField("__predicted", IntegerType())]))
