"""Enough tasks for CPU-heavy work on few input files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Redistribute the rows of a scan that has fewer splits than there are cores.

    Text work on one large file would keep a single core busy. A table of many
    files, as on a cluster, is returned as it is and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def widen(df: DataFrame) -> DataFrame:
    """As many tasks as a shuffle has, for rows that expand into many more.

    Adaptive execution sizes tasks by their input, so a small table of names
    that grows a hundredfold would otherwise be expanded by one task.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks)
