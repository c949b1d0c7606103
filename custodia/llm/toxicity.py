"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts and unlabelled texts are learnt from; nothing counts as a confirmed negative. Features are the presence of words
and of their first four to six letters. Those clearly commoner in positives than in the unlabelled texts are kept, and
linear classifiers minimise the class-prior-corrected risk

    prior * E_p[l(z, +1)] + max(0, E_u[l(z, -1)] - prior * E_p[l(z, -1)])

with the logistic loss; where the part in the maximum falls below zero, its gradient is reversed. Several classifiers, fitted to
resampled rows, vote with their mean probability.

The fit uses bounded samples (``MAX_POSITIVE``, ``MAX_UNLABELLED``, documented parameters) with one row for each text; a
document is scored on its whole text. Results for odd input: null and empty texts have no feature and get the score of
the intercept; without positives every score is the prior; repeated rows are scored one by one; extra columns are not read.
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

MAX_POSITIVE, MAX_UNLABELLED = 4_000, 8_000
#: Features kept at most, positives that must hold one, and its least distance from the unlabelled rate in standard deviations.
MAX_FEATURES, MIN_POSITIVE, MIN_DISTANCE = 4096, 5, 6.0
#: Least share of toxic texts, by the prior and the two rates, among the texts that hold a kept feature.
MIN_SHARE = 0.6
PREFIXES = (4, 5, 6)
MEMBERS, STEPS, RATE, DECAY, SEED = 3, 400, 0.05, 1e-4, 11
_WORD = re.compile(r"\w+")


def features(word: str) -> tuple[int, ...]:
    """Hashes of a lower-cased word and of its beginnings."""
    parts = [f"={word}", *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return tuple(xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) >> 1 for p in parts)


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass(frozen=True)
class Model:
    """Weights per kept feature (row: member), intercepts, and the place of each feature."""

    weights: np.ndarray
    intercepts: np.ndarray
    places: dict[int, int]

    def cache(self) -> Cache:
        return Cache(lambda w: tuple(self.places[f] for f in features(w) if f in self.places))

    def score(self, text: str | None, cache: Cache) -> float:
        at: set[int] = set()
        for found in map(cache.__getitem__, words(text)):
            if found:
                at.update(found)
        z = self.intercepts + self.weights[:, sorted(at)].sum(axis=1)
        return float(sigmoid(z).mean())


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def nnpu(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """One linear classifier; rows and cols list the features present, positive and unlabelled are weights of the rows."""
    n, p, u = len(positive), positive / positive.sum(), unlabelled / unlabelled.sum()
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, STEPS + 1):
        z = b + np.bincount(rows, w[cols], n)
        s = sigmoid(z)
        inner = u @ softplus(z) - prior * (p @ softplus(z))
        dz_inner = (u - prior * p) * s
        dz = prior * p * (s - 1) + dz_inner if inner >= 0 else -dz_inner
        g = np.append(np.bincount(cols, dz[rows], n_features) + DECAY * w, dz.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit(docs: DataFrame, positives: DataFrame, prior: float, id_col: str = "doc_id", text_col: str = "text", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Learn from ``docs``; ``positives`` holds the ids of the confirmed toxic ones, ``prior`` is the share of toxic texts."""
    spark = docs.sparkSession
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    pos, unl = set(chosen_ids(positives, positives.columns[0], max_positive, SEED)), set(chosen_ids(docs, id_col, max_unlabelled, SEED + 1))
    nothing = Model(np.zeros((1, 0)), np.array([np.log(prior / (1 - prior))]), {})
    if not pos or not unl:
        return nothing
    id_type = docs.schema[id_col].dataType.simpleString()
    marks = spark.createDataFrame([(i, i in pos, i in unl) for i in pos | unl], f"__id {id_type}, positive boolean, unlabelled boolean")
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "__id")
    once = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, p, u in texts(batches, "text", "positive", "unlabelled"):
            rows = [np.array(sorted({f for w in words(t) for f in features(w)}), np.int64) for t in text]
            found, inverse = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.int64), return_inverse=True)
            sizes = [len(r) for r in rows]
            n_p, n_u = (np.bincount(inverse, np.repeat(np.array(x, float), sizes), len(found)).astype(np.int64) for x in (p, u))
            yield pa.RecordBatch.from_pydict({"feature": found, "p": n_p, "u": n_u})

    totals = once.agg(F.sum(F.col("positive").cast("int")), F.sum(F.col("unlabelled").cast("int"))).first()
    if not totals[0] or not totals[1]:
        return nothing
    counts = map_arrow(once.select("text", "positive", "unlabelled"), count, "feature long, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    rate_p, rate_u = F.col("p") / totals[0], (F.col("u") + 1) / (totals[1] + 2)
    distance = (rate_p - rate_u) / F.sqrt(rate_u * (1 - rate_u) / totals[0])
    best = counts.where((F.col("p") >= MIN_POSITIVE) & (prior * rate_p >= MIN_SHARE * rate_u)).select("feature", distance.alias("d")).where(F.col("d") >= MIN_DISTANCE).orderBy(F.desc("d"), "feature").limit(MAX_FEATURES)
    places = {r["feature"]: i for i, r in enumerate(best.collect())}
    if not places:
        return nothing

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, p, u in texts(batches, "text", "positive", "unlabelled"):
            at = [sorted({places[f] for w in words(t) for f in features(w) if f in places}) for t in text]
            yield pa.RecordBatch.from_pydict({"p": p, "u": u, "at": pa.array(at, pa.list_(pa.int32()))})

    data = map_arrow(once.select("text", "positive", "unlabelled"), place, "p boolean, u boolean, at array<int>").toPandas()
    data = data.assign(key=data["at"].map(lambda a: tuple(map(int, a)))).sort_values(["p", "u", "key"]).reset_index(drop=True)  # the same order in every run
    sizes = data["at"].map(len).to_numpy()
    rows, cols = np.repeat(np.arange(len(data)), sizes), np.concatenate([*data["at"], np.zeros(0, int)]).astype(int)
    rng, members = np.random.default_rng(SEED), []
    for _ in range(MEMBERS):
        p, u = (rng.poisson(1, len(data)) * data[c].to_numpy(float) for c in ("p", "u"))
        if p.sum() and u.sum():
            members.append(nnpu(rows, cols, p, u, len(places), prior))
    if not members:
        return nothing
    return Model(np.stack([w for w, _ in members]), np.array([b for _, b in members]), places)


def apply(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """All columns of ``docs`` plus ``__score`` and ``__predicted``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = model.cache()
        for batch in batches:
            score = np.array([model.score(t, cache) for t in batch.column(at).to_pylist()], float)
            columns = [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "__score", "__predicted"])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField("__score", DoubleType()), StructField("__predicted", IntegerType())]))
