"""Word counts over a stream of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.text import word_count, words_of
from logloom.streaming.batches import run_available


def batch_word_counts(spark: SparkSession, lines: DataFrame, text: str = "value") -> DataFrame:
    """(batch_id, word, count): each batch on its own, nothing carried over."""
    tables = run_available(
        spark, lines.select(F.col(text).alias("value")), {"word_counts": word_count}
    )
    return tables["word_counts"].select("batch_id", "word", "count")


def running_word_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    """Counts since the start of the stream (use output mode ``complete``)."""
    return words_of(lines, text).groupBy("word").count()
