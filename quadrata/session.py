"""Session set-up, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "quadrata", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on: AQE with skew splitting, UTC, Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: the configured checkpoint folder, or a new one in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="quadrata-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor never changes what was computed.

    The shuffle files of the job are of no use once its result is written; where Spark can, it deletes them at the end.
    """
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under this setting
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a table in the shared folder, read again.

    Where a loop feeds its result to its next round, this is better than a checkpoint: the plan of a checkpoint remembers
    all that the optimiser has inferred of its columns, which grows with every round.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def load_spread(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table for expensive row expressions without a shuffle of their own: every core gets a share of the rows.

    The rows of one Parquet row group cannot be read by several tasks, so a scan of fewer splits than cores would leave
    cores idle for the whole expression; such rows are dealt out first. Any table of more splits is scanned as it is. The rows
    are the same either way.
    """
    df = load(spark, folder, table)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
