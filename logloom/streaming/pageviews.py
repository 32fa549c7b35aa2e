"""Page-view metrics over a stream of access-log lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.weblog import (
    page_views,
    pages_only,
    parse_access_log,
    referral_counts,
    session_ids,
)
from logloom.streaming.batches import run_available, store_batches

METRICS = {
    "page_views": page_views,
    "referrals": referral_counts,
    "sessions": session_ids,
}


def parsed_pages(lines: DataFrame) -> DataFrame:
    """Parse log lines and keep page requests (stateless, batch or stream)."""
    return pages_only(parse_access_log(lines, session=True))


def page_metrics(
    spark: SparkSession, lines: DataFrame, folder: str | None = None, names: Sequence[str] = tuple(METRICS)
):
    """The per-batch tables of the named metrics (all three by default) of what the stream holds now."""
    chosen = {name: METRICS[name] for name in names}
    return run_available(spark, lines, chosen, prepare=parsed_pages, folder=folder)


def start_page_metrics(lines: DataFrame, folder: str, interval: str = "10 seconds"):
    """Start the continuous form: every batch adds to three stored tables."""
    return store_batches(lines, METRICS, folder, prepare=parsed_pages, processingTime=interval)


def _windowed(pages: DataFrame, length: str, delay: str) -> DataFrame:
    return pages.withWatermark("ts", delay).withColumn("window", F.window("ts", length))


def windowed_page_views(pages: DataFrame, length: str, delay: str = "1 hour") -> DataFrame:
    """Views per event-time window and page; a window closes after ``delay``."""
    counts = _windowed(pages, length, delay).groupBy("window", "requested_resource")
    return counts.agg(F.count(F.lit(1)).alias("views"))


def windowed_referrals(pages: DataFrame, length: str, delay: str = "1 hour") -> DataFrame:
    counts = _windowed(pages, length, delay).groupBy("window", "referer", "requested_resource")
    return counts.agg(F.count(F.lit(1)).alias("referrals"))


def windowed_sessions(pages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each session id once while its state lives."""
    ids = pages.select("ts", F.col("session_raw").alias("session_id"))
    return ids.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["session_id"])
