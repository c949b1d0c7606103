"""Shared pieces of the training-data operators: words, splits, samples, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.session import shared_dir

#: Entries of a per-worker cache before it is emptied; bounds a worker's memory, never a result.
CACHE_ENTRIES = 250_000
#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(col: str, divisor: int) -> Column:
    """crc32 of a value written as text, modulo a divisor; a null value counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % divisor


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors.

    The driver collects its garbage first: only then does Spark delete the shuffle files of jobs that are done, and the
    driver's memory does not fill with their plans and generated classes.
    """
    spark = df.sparkSession
    spark.sparkContext._jvm.System.gc()
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """As ``stored``, in a table with buckets of a column: grouping and cogrouping by it read the files where they lie, without a shuffle.

    The table is external and stands in the session's catalog until ``dropped``.
    """
    spark = df.sparkSession
    spark.sparkContext._jvm.System.gc()
    label = f"llm-{name}-{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/{label}"
    df.write.format("parquet").bucketBy(buckets, column).option("compression", "zstd").option("path", path).saveAsTable(label.replace("-", "_"))
    return spark.read.table(label.replace("-", "_"))


def dropped(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        label = folder.rpartition("/")[2]
        if label.startswith("llm-"):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            spark.sql(f"DROP TABLE IF EXISTS {label.replace('-', '_')}")


_inside: dict = {"job": None, "leave": None}


def enter(job: str) -> None:
    """A worker is reused for other operators: what the one before remembered is released then."""
    if _inside["job"] != job and _inside["leave"]:
        _inside["leave"]()
    if _inside["job"] != job:
        _inside.update(job=job, leave=None)
        give_back()


def give_back() -> None:
    """Return freed memory to the machine, which the allocators of a long-lived worker would keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def on_leave(release) -> None:
    """Called when this worker begins another operator."""
    _inside["leave"] = release


def map_arrow(df: DataFrame, job, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes, so that long texts do not fill a worker's memory.

    The session setting is filled in only where the user has not chosen one.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    name = f"{job.__module__}.{job.__qualname__}"

    def run(batches):
        from custodia.llm import common  # the worker's own module, not a copy of its state

        common.enter(name)
        yield from job(batches)

    return df.mapInArrow(run, schema)


def ascii_lower(col: Column) -> Column:
    """A-Z only, as the word contracts ask; other letters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def raw_words(text: str | None) -> list[bytes]:
    """Maximal runs without the six ASCII space characters, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """As ``raw_words`` with A-Z lower-cased: ``bytes.lower`` touches ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Cache(dict):
    """word -> value of ``make(word)``, emptied when it grows past its bound."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.make(key)
        return value


def hash_cache() -> Cache:
    return Cache(xxhash.xxh64_intdigest)


def hashes(words: list[bytes], cache: Cache) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive word hashes; empty with fewer words."""
    if len(h) < n:
        return h[:0]
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = mixed(out + h[i : len(h) - n + 1 + i] + np.uint64(i + 1))
    return out


def texts(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """Columns of each Arrow batch as lists."""
    for batch in batches:
        yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)


def chosen_ids(df: DataFrame, id_col: str, limit: int, seed: int) -> list[int]:
    """At most ``limit`` distinct ids in an order fixed by a hash: the bounded sample of a fit."""
    picked = df.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    rows = picked.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(limit).collect()
    return [r[0] for r in rows]
