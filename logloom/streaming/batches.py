"""Running a per-batch computation over a stream and keeping its results."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from logloom.session import work_dir


def print_batches(stream: DataFrame, **trigger):
    """Start a query that prints every micro-batch."""
    writer = stream.writeStream.format("console").outputMode("append")
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def store_batches(
    stream: DataFrame,
    metrics: Mapping[str, Callable[[DataFrame], DataFrame]],
    folder: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    **trigger,
):
    """Start a query that stores one table per metric, one partition per batch.

    Each batch is prepared once and kept in memory while the metrics read it.
    A batch overwrites only its own ``batch_id`` folder, so a replayed batch
    leaves the same tables behind.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = (prepare(batch) if prepare else batch).persist()
        try:
            for name, metric in metrics.items():
                target = f"{folder}/{name}/batch_id={batch_id}"
                metric(rows).write.mode("overwrite").parquet(target)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(store)
    writer = writer.option("checkpointLocation", f"{folder}/_progress")
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def run_available(
    spark: SparkSession,
    stream: DataFrame,
    metrics: Mapping[str, Callable[[DataFrame], DataFrame]],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Process what is there now and return the stored per-batch tables."""
    target = folder or work_dir(spark, "stream")
    nothing = spark.createDataFrame([], stream.schema)
    schemas = {name: metric(prepare(nothing) if prepare else nothing).schema for name, metric in metrics.items()}
    for name, schema in schemas.items():
        # a part without rows: the table exists even if no batch ever comes
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{target}/{name}/batch_id=-1")
    query = store_batches(stream, metrics, target, prepare, availableNow=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return {
        name: spark.read.schema(StructType([*schema, StructField("batch_id", IntegerType())])).parquet(f"{target}/{name}")
        for name, schema in schemas.items()
    }


def sum_batches(per_batch: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Totals over all batches of an additive metric."""
    return per_batch.groupBy(*keys).agg(F.sum(count).alias(count))


def append_available(spark: SparkSession, stream: DataFrame, folder: str | None = None):
    """Write an append-mode stream to Parquet until nothing is left, and read it back."""
    target = folder or work_dir(spark, "stream")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{target}/_progress")
        .trigger(availableNow=True)
        .start(f"{target}/rows")
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stream.schema).parquet(f"{target}/rows")
