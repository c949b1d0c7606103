"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are tuned for. Shuffle partitions are left to the cluster;
# AQE coalesces them when a stage turns out small and splits skewed joins.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a busy session is merged within each task before its shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: str = "8", app: str = "custodia") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        # shorter call-site capture: building long column expressions is faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only where a session names none (tests, a laptop) a temporary folder is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="custodia-"))
    return spark.sparkContext.getCheckpointDir()


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later branches read the same rows, also after executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
