"""Sinks. Writers run on the executors; nothing passes through the driver."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.text import flatten_whitespace


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).save(path)


def write_text(df: DataFrame, path: str, sep: str = ",") -> None:
    """Aggregates as delimited text files in a folder; blanks in cells are kept."""
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").csv(path, sep=sep, **blanks)


def write_tsv(df: DataFrame, path: str, compress: bool = False) -> None:
    """Headered TSV, optionally gzip; line breaks and tabs in cells become spaces."""
    cells = [
        flatten_whitespace(F.col(f.name)).alias(f.name)
        if f.dataType.simpleString() == "string"
        else F.col(f.name)
        for f in df.schema.fields
    ]
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if compress:
        options["compression"] = "gzip"
    df.select(*cells).write.mode("overwrite").csv(path, sep="\t", header=True, **options)


def write_labels(labels: DataFrame, path: str) -> None:
    """(label, idx) as JSON lines."""
    labels.select("label", "idx").write.mode("overwrite").json(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, schema="label STRING, idx INT")


def drop_self_pairs(recs: DataFrame) -> DataFrame:
    return recs.where("base_id != item_id")


def upsert_recommendations(
    recs: DataFrame,
    connect: Callable[[], object],
    statement: str,
    batch: int = 100,
) -> None:
    """Keyed upsert of (base_id, item_id, relevance) through a DB-API connection.

    ``connect`` is called once per partition, on the executor; ``statement`` is
    the store's upsert with three placeholders. Self pairs never reach the
    store. Being keyed, a retried task writes the same rows again.
    """

    def save(rows):
        connection = connect()
        try:
            cursor = connection.cursor()
            values = ((r.base_id, r.item_id, r.relevance) for r in rows)
            while chunk := list(itertools.islice(values, batch)):
                cursor.executemany(statement, chunk)
                connection.commit()
        finally:
            connection.close()

    clean = drop_self_pairs(recs).select("base_id", "item_id", "relevance")
    clean.foreachPartition(save)


def write_recommendations_jdbc(recs: DataFrame, url: str, table: str, batch: int = 100, **props):
    """Append self-pair-free recommendations to a staging table over JDBC."""
    properties = {**props, "batchsize": str(batch)}
    drop_self_pairs(recs).write.jdbc(url, table, mode="append", properties=properties)


def accumulate(
    new: DataFrame, path: str, key: Sequence[str], target: str, prefer: str = "old"
) -> DataFrame:
    """Merge ``new`` into the table at ``path`` and write the result to ``target``.

    The old table is only read, so a failed job leaves it intact; the caller
    switches to ``target`` afterwards.
    """
    from logloom.operators.cleaning import merge_previous

    spark = new.sparkSession
    merged = merge_previous(new, spark.read.parquet(path), key, prefer)
    write_table(merged, target)
    return spark.read.parquet(target)
