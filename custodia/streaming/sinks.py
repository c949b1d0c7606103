"""Running streams to tables in shared storage, and micro-batch jobs with state tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from custodia.operators import agents, audit, tokens
from custodia.operators.ordered import ordered_window
from custodia.session import pinned, shared_dir
from custodia.sources import dims, schemas
from custodia.streaming.reorder import EpochTable, Released, Reorder


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Process what is there, append the result as parquet, and read it back."""
    spark = stream.sparkSession
    base = fresh_dir(spark, name)
    q = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def run_batches(stream: DataFrame, base: str, step: Callable[[DataFrame, int], None]) -> None:
    """Run ``step`` on every micro-batch.

    A stream's session has adaptive execution off. The steps are ordinary batch
    jobs that count on it for skewed joins and file sizes, so it is put on again.
    """

    def adaptive(batch: DataFrame, epoch: int) -> None:
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        step(batch, epoch)

    q = (
        stream.writeStream.foreachBatch(adaptive).option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()


def table_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The parquet table at ``path``, or None before its first write."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(schema).parquet(path) if fs.exists(p) else None


def append_by_day(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write partitioned by ``dt``. Rebalancing gathers small days and splits a day that fills the batch."""
    rows.hint("rebalance", "dt").write.mode(mode).partitionBy("dt").parquet(path)


def append_audit(base: str, order: list[str], lookback_days: int | None = None) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: exactly one row per event id in ``{base}/log``.

    A batch that is run again after a failure finds its events in the log and
    adds none twice. With ``lookback_days`` only recent partitions of the log are
    compared, for sources that cannot repeat an event later than that.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn("dt", F.to_date("ts"))
        log = table_or_none(spark, f"{base}/log", dated.schema)
        if log is None:
            rows = audit.first_per_event(dated, order)
        else:
            if lookback_days is not None:
                first = dated.agg(F.min("dt")).first()[0]
                log = log.where(F.col("dt") >= F.date_sub(F.lit(first), lookback_days))
            rows = audit.new_rows(log, dated, order)
        append_by_day(pinned(rows), f"{base}/log")

    return step


def append_token_map(base: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: write-once token records in ``{base}/map``.

    Puts are reduced per token before they are shuffled, so a token that fills
    the batch is no bottleneck. Only records that live at the first put are
    compared, whatever their own time to live. A repeated batch is blocked by its own first attempt.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        puts = pinned(batch.select(*tokens.FIELDS))
        if puts.isEmpty():
            return
        known = table_or_none(spark, f"{base}/map", schemas.TOKEN_MAP + ", dt DATE")
        if known is not None:
            known = tokens.living(known, puts)
        new = tokens.write_once(known, puts).withColumn("dt", F.to_date("created_at"))
        append_by_day(pinned(new), f"{base}/map")

    return step


def _run_state(key: str) -> str:
    return f"{key} STRING, carried BIGINT, carried_from TIMESTAMP"


def _null_safe(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on a key for which null is a key of its own."""
    both = left.withColumn("__l", F.lit(True)).join(right.withColumnRenamed(key, "__k"), F.col(key).eqNullSafe(F.col("__k")), how)
    return both.withColumn(key, F.when(F.col("__l").isNull(), F.col("__k")).otherwise(F.col(key))).drop("__k", "__l")


def _grown_runs(rows: DataFrame, state: DataFrame | None, key: str, score: str, order: list[str], bound: float) -> DataFrame:
    """Runs of low scores in ``rows``, the first of a key going on with its carried run: their length before and now, start, and
    whether they are still open. A key without rows keeps its run; one whose rows begin with a good score ends it.

    The rows are ordered in a distributed way, so a key that carries most of the traffic is no bottleneck.
    """
    low = F.coalesce(F.col(score) < bound, F.lit(False))
    marked = ordered_window(
        rows.select(key, *order, score).withColumn("__low", low), [key], order, running={"island": ("sum", (~F.col("__low")).cast("bigint"))}
    )
    per = marked.groupBy(key, "island").agg(F.count_if("__low").alias("run_length"), F.min(F.when(F.col("__low"), F.col(order[0]))).alias("started"))
    last = per.groupBy(key).agg(F.max("island").alias("last_island"))
    # island 0 holds the rows before the first good score, if any
    first = last.select(key, F.lit(0).cast("bigint").alias("island"), F.lit(0).cast("bigint").alias("run_length"), F.lit(None).cast("timestamp").alias("started"))
    islands = per.unionByName(first).groupBy(key, "island").agg(F.sum("run_length").alias("run_length"), F.min("started").alias("started"))
    runs = _null_safe(islands, last, key, "left")
    if state is None:
        runs = runs.withColumns({"carried": F.lit(0).cast("bigint"), "carried_from": F.lit(None).cast("timestamp")})
    else:
        runs = _null_safe(runs, state, key, "full")
    goes_on = F.coalesce(F.col("island"), F.lit(0)) == 0
    before = F.when(goes_on, F.coalesce("carried", F.lit(0))).otherwise(F.lit(0))
    return runs.select(
        key, before.alias("before"), (before + F.coalesce("run_length", F.lit(0))).alias("run_length"),
        F.when(goes_on, F.coalesce("carried_from", "started")).otherwise(F.col("started")).alias("started"),
        (F.coalesce("island", F.lit(0)) == F.coalesce("last_island", F.lit(0))).alias("open"),
    )


def _carried(runs: DataFrame, key: str) -> DataFrame:
    """One row per key."""
    return runs.where("open").select(key, F.col("run_length").alias("carried"), F.col("started").alias("carried_from"))


def low_run_alerts(
    base: str, key: str, score: str, order: list[str],
    bound: float = dims.LOW_CONSISTENCY, longer_than: int = dims.LOW_CONSISTENCY_RUN,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch step for sources that deliver in order: alert once when a run of low scores grows beyond ``longer_than``.

    Rows are taken as they arrive; ``LowRuns`` puts them in order first. Re-running a batch overwrites its own output only.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        state = EpochTable(base, "state", _run_state(key))
        merged = _grown_runs(batch, state.read(batch.sparkSession, epoch - 1), key, score, order, bound)
        grown = (F.col("run_length") > longer_than) & (F.col("before") <= longer_than)
        merged.where(grown).select(key, "started", "run_length").write.mode("overwrite").parquet(f"{base}/alerts/epoch={epoch}")
        state.write(_carried(merged, key), epoch)

    return step


class Ordered:
    """Micro-batch job over rows in the order of their event time.

    A subclass names the columns it needs and handles what the buffer releases. ``finish`` ends a stream that is known
    to be over: it releases the rows that the watermark has not passed.
    """

    ts = "ts"
    columns: str
    alert_columns: str

    def __init__(self, base: str, delay_seconds: int = 600):
        self.base, self.last = base, -1
        self.buffer = Reorder(base, self.ts, delay_seconds)

    def __call__(self, batch: DataFrame | None, epoch: int, spark: SparkSession | None = None) -> None:
        spark = spark or batch.sparkSession
        schema = StructType.fromDDL(self.columns)
        if batch is not None:
            batch = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        self.handle(spark, self.buffer.release(batch, spark, epoch, schema), epoch)
        self.last = epoch

    def finish(self, spark: SparkSession) -> None:
        self(None, self.last + 1, spark)

    def handle(self, spark: SparkSession, released: Released, epoch: int) -> None:
        raise NotImplementedError

    def written(self, spark: SparkSession, name: str, columns: str) -> DataFrame:
        """What all batches wrote; nothing before the first one."""
        rows = table_or_none(spark, f"{self.base}/{name}", columns)
        return spark.createDataFrame([], columns) if rows is None else rows

    def alerts(self, spark: SparkSession) -> DataFrame:
        return self.written(spark, "alerts", self.alert_columns)

    def write(self, name: str, rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.base}/{name}/epoch={epoch}")


class LowRuns(Ordered):
    """Runs of low scores longer than ``longer_than``.

    ``alerts`` has a row per run, written when the run grows beyond the bound; ``runs`` has its length, written when a better score, or the end
    of the stream, closes it. Neither depends on how the stream was cut. The open run of every key is carried; rows
    are ordered in a distributed way, so a key that carries most of the traffic is no bottleneck.
    """

    def __init__(
        self, base: str, key: str, score: str, order: list[tuple[str, str]], delay_seconds: int = 600,
        bound: float = dims.LOW_CONSISTENCY, longer_than: int = dims.LOW_CONSISTENCY_RUN,
    ):
        self.key, self.score, self.order = key, score, [name for name, _ in order]
        self.ts, self.columns = self.order[0], ", ".join([f"{key} STRING", f"{score} DOUBLE", *[f"{n} {t}" for n, t in order]])
        self.bound, self.longer_than = bound, longer_than
        self.alert_columns = f"{key} STRING, started {order[0][1]}"
        super().__init__(base, delay_seconds)

    def handle(self, spark: SparkSession, released: Released, epoch: int) -> None:
        state = EpochTable(self.base, "state", _run_state(self.key))
        runs = pinned(_grown_runs(released.rows, state.read(spark, epoch - 1), self.key, self.score, self.order, self.bound))
        long = F.col("run_length") > self.longer_than
        self.write("alerts", runs.where(long & (F.col("before") <= self.longer_than)).select(self.key, "started"), epoch)
        closed = F.lit(True) if released.ended else ~F.col("open")
        self.write("runs", runs.where(long & closed).select(self.key, "started", "run_length"), epoch)
        state.write(_carried(runs, self.key), epoch)

    def runs(self, spark: SparkSession) -> DataFrame:
        return self.written(spark, "runs", self.alert_columns + ", run_length BIGINT")


class RateLimit(Ordered):
    """Moments at which an agent's calls of a tool exceed the tool's limit, exactly as in batch, in every unit.

    Calls are carried as counts per agent, tool and moment, as far back as a limit reaches; the trailing
    counts of a release are running sums over those cells and its own.
    """

    columns = "agent STRING, tool STRING, ts TIMESTAMP"
    alert_columns = "agent STRING, tool STRING, ts TIMESTAMP, n_trailing BIGINT, allowed INT"
    _cells = "tool STRING, agent STRING, ts TIMESTAMP, n BIGINT, per_window INT, window_s INT"

    def __init__(self, base: str, registry: DataFrame, delay_seconds: int = 600):
        self.registry = registry
        super().__init__(base, delay_seconds)

    def handle(self, spark: SparkSession, released: Released, epoch: int) -> None:
        table = EpochTable(self.base, "recent", self._cells)
        # a moment is released as a whole, so its cell is complete
        cells = agents.limited_cells(released.rows, self.registry).select(*StructType.fromDDL(self._cells).names)
        before = table.read(spark, epoch - 1)
        cells = pinned(cells if before is None else cells.unionByName(before))
        over = agents.over_limit(cells)
        self.write("alerts", over if released.since is None else over.where(F.unix_micros("ts") >= released.since), epoch)
        reach = F.col("ts") + F.make_dt_interval(secs=F.col("window_s"))
        table.write(cells.where(~released.passed(reach)), epoch)


class MessageTtl(Ordered):
    """Messages whose successor does not come within their own time to live.

    Open messages are carried with their deadlines, each its own, however long. A successor (the next number of the chain) closes a
    message if it comes between the message and its deadline; once the watermark has passed the deadline, every such
    successor has been released, and a message that is still open has expired. A message without a time to live never expires.
    """

    ts = "created_at"
    columns = "trace_id BIGINT, seq BIGINT, created_at TIMESTAMP, ttl_seconds BIGINT"
    alert_columns = "trace_id BIGINT, seq BIGINT, created_at TIMESTAMP"

    def handle(self, spark: SparkSession, released: Released, epoch: int) -> None:
        table = EpochTable(self.base, "open", self.columns)
        before = table.read(spark, epoch - 1)
        messages = released.rows if before is None else released.rows.unionByName(before)
        reply = released.rows.select(F.col("trace_id").alias("r_trace"), (F.col("seq") - 1).alias("r_seq"), F.col("created_at").alias("r_at"))
        deadline = F.col("created_at") + F.make_dt_interval(secs=F.col("ttl_seconds"))
        answered = (F.col("trace_id") == F.col("r_trace")) & (F.col("seq") == F.col("r_seq")) & (F.col("r_at") >= F.col("created_at")) & (F.col("r_at") <= deadline)
        still = pinned(messages.where(F.col("ttl_seconds").isNotNull()).join(reply, answered, "left_anti"))
        self.write("alerts", still.where(released.passed(deadline)).select("trace_id", "seq", "created_at"), epoch)
        table.write(still.where(~released.passed(deadline)), epoch)
