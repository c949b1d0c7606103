"""Rows of micro-batches in the order of their event time.

Files and topics deliver rows out of order. The buffer keeps every row until the watermark - the newest event time seen,
less the allowed delay - has passed it, and then releases it: all rows released by one batch lie before all rows released by a later
one, however the stream was cut into batches. What a job then carries from batch to batch may rely on that order. Rows that
come after the watermark has passed them are late; they are dropped and counted.

State is one small table per batch number, written before the batch ends and read by the next one, so a batch that is run again after a
failure reads what it read before and overwrites only what it wrote itself. Tables of older batches are deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from custodia.session import pinned

_CLOCK = "watermark BIGINT, late BIGINT"


def folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class EpochTable:
    """A table with one version per batch number; only the last two are kept."""

    def __init__(self, base: str, name: str, schema):
        self.path, self.schema = f"{base}/{name}", schema

    def _at(self, epoch: int) -> str:
        return f"{self.path}/epoch={epoch}"

    def read(self, spark: SparkSession, epoch: int) -> DataFrame | None:
        p, fs = folder(spark, self._at(epoch))
        return spark.read.schema(self.schema).parquet(self._at(epoch)) if fs.exists(p) else None

    def write(self, df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(self._at(epoch))
        p, fs = folder(df.sparkSession, self._at(epoch - 2))
        if fs.exists(p):
            fs.delete(p, True)


@dataclass(frozen=True)
class Released:
    """Rows whose time the watermark passed with this batch: not before ``since``, and before ``until`` (microseconds)."""

    rows: DataFrame
    since: int | None
    until: int | None
    ended: bool = False

    def passed(self, ts: Column) -> Column:
        """The time lies before the watermark; at the end of a stream every time does."""
        if self.until is None:
            return F.lit(self.ended)
        return F.unix_micros(ts) < self.until


class Reorder:
    """Watermark-released buffer in front of a job's own state."""

    def __init__(self, base: str, ts: str, delay_seconds: int = 600):
        self.base, self.ts, self.delay = base, ts, delay_seconds * 1_000_000

    def release(self, batch: DataFrame | None, spark: SparkSession, epoch: int, schema: StructType) -> Released:
        """What the watermark has passed with this batch; a batch of None ends the stream and releases the rest."""
        clock, buffer = EpochTable(self.base, "clock", _CLOCK), EpochTable(self.base, "buffer", schema)
        old = clock.read(spark, epoch - 1)
        since = old.first()["watermark"] if old is not None else None
        held = buffer.read(spark, epoch - 1)
        held = spark.createDataFrame([], schema) if held is None else held
        if batch is None:
            clock.write(spark.createDataFrame([(since, 0)], _CLOCK), epoch)
            buffer.write(held.limit(0), epoch)
            return Released(held, since, None, ended=True)
        at = F.unix_micros(self.ts)
        # read once: the steps below would each read the batch's files or topics again
        fresh = pinned(batch.where(F.col(self.ts).isNotNull()))
        late = F.lit(False) if since is None else at < since
        newest, n_late = fresh.agg(F.max(at), F.count_if(late)).first()
        until = max((t for t in (since, None if newest is None else newest - self.delay) if t is not None), default=None)
        known = held.unionByName(fresh.where(~late))
        out = Released(known, since, until)
        # both read what the batch before wrote and what was pinned, so they agree
        buffer.write(known.where(~out.passed(F.col(self.ts))), epoch)
        clock.write(spark.createDataFrame([(until, n_late)], _CLOCK), epoch)
        return Released(known.where(out.passed(F.col(self.ts))), since, until)


def late_rows(spark: SparkSession, base: str) -> int:
    """Rows dropped by the last batch because they came after the watermark."""
    path = f"{base}/clock"
    clock = spark.read.schema(_CLOCK + ", epoch INT").parquet(path)
    return clock.orderBy(F.desc("epoch")).first()["late"]
