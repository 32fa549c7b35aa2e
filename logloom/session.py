"""Session factory and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Everything here is safe to set on a running session; the values hold for a
# laptop and for a large cluster because AQE sizes the partitions at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # hash instead of sort where the measured partitions of one side are small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows hold whole texts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def get_session(app: str = "logloom", master: str | None = None, **conf) -> SparkSession:
    """Build (or get) a session: UTC, ANSI on, AQE with skew-join handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, "spark.sql.ansi.enabled": "true", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Only a local session without the setting gets a temporary folder: on a
    cluster a machine-local folder is lost with the machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = context.getCheckpointDir()
        if current:
            return current
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="logloom-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result outlives the executors that made it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: While set, the shuffle files of a query are removed when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """The rows as compressed Parquet files in the shared folder.

    Smaller than a checkpoint, and the shuffle files that made them do not stay on the
    disks; the partitioning is lost.
    """
    spark = df.sparkSession
    path, before = work_dir(spark, "rows"), spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
