"""The streaming operators, run over what the tables hold now."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.catalog.base import Tables, query
from logloom.catalog.logs import LOG_SQL, log_lines
from logloom.session import work_dir
from logloom.streaming import batches, pageviews, wordcount


def stream_of(t: Tables, name: str) -> DataFrame:
    """A stream of a table's Parquet files: one file of the table's name, or a folder of them."""
    schema = getattr(t, name).schema
    # a stream takes a folder or a pattern, and the pattern fits the table alone
    return t.spark.readStream.schema(schema).parquet(f"{t.folder}/{name}.parque[t]")


WORD_SQL = r"""
WITH cut AS (
  SELECT CASE WHEN length(text) = 0 THEN ['']
              WHEN length(rtrim(text, ' ')) = 0 THEN []
              ELSE string_split(rtrim(text, ' '), ' ') END AS l FROM documents
)
SELECT word, count(*) AS n FROM (SELECT unnest(l) AS word FROM cut) GROUP BY word
"""


@query("stream_word_count", WORD_SQL)
def stream_word_count(t: Tables) -> DataFrame:
    per_batch = wordcount.batch_word_counts(t.spark, stream_of(t, "documents"), "text")
    return batches.sum_batches(per_batch, ["word"], "count").withColumnRenamed("count", "n")


def _metric(t: Tables, name: str) -> DataFrame:
    lines = log_lines(stream_of(t, "events"))
    return pageviews.page_metrics(t.spark, lines, names=[name])[name]


@query(
    "stream_page_views",
    LOG_SQL + "SELECT uri AS requested_resource, count(*) AS views FROM pages GROUP BY 1",
)
def stream_page_views(t: Tables) -> DataFrame:
    return batches.sum_batches(_metric(t, "page_views"), ["requested_resource"], "views")


@query(
    "stream_referrals",
    LOG_SQL
    + "SELECT referer, uri AS requested_resource, count(*) AS referrals FROM pages GROUP BY 1, 2",
)
def stream_referrals(t: Tables) -> DataFrame:
    return batches.sum_batches(
        _metric(t, "referrals"), ["referer", "requested_resource"], "referrals"
    )


@query("stream_sessions", LOG_SQL + """SELECT DISTINCT '"' || sid || '"' AS session_id FROM pages""")
def stream_sessions(t: Tables) -> DataFrame:
    return _metric(t, "sessions").select("session_id").distinct()


@query(
    "stream_windowed_views",
    LOG_SQL
    + """
    , bounds AS (SELECT max(date_trunc('second', ts)) - INTERVAL 1 HOUR AS mark FROM pages)
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, uri AS requested_resource, count(*) AS views
    FROM pages, bounds WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark GROUP BY 1, 2
    """,
)
def stream_windowed_views(t: Tables) -> DataFrame:
    """Daily windows in event time; a window appears once the watermark has passed it."""
    pages = pageviews.parsed_pages(log_lines(stream_of(t, "events")))
    views = pageviews.windowed_page_views(pages, "1 day", "1 hour")
    flat = views.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"), "requested_resource", "views"
    )
    return batches.append_available(t.spark, flat)




@query(
    "stream_windowed_referrals",
    LOG_SQL
    + """
    , bounds AS (SELECT max(date_trunc('second', ts)) - INTERVAL 1 HOUR AS mark FROM pages)
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, referer, uri AS requested_resource, count(*) AS referrals
    FROM pages, bounds WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark GROUP BY 1, 2, 3
    """,
)
def stream_windowed_referrals(t: Tables) -> DataFrame:
    """Daily referral windows in event time."""
    pages = pageviews.parsed_pages(log_lines(stream_of(t, "events")))
    referrals = pageviews.windowed_referrals(pages, "1 day", "1 hour")
    flat = referrals.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"), "referer", "requested_resource", "referrals"
    )
    return batches.append_available(t.spark, flat)


@query(
    "stream_windowed_sessions",
    LOG_SQL + """SELECT DISTINCT '"' || sid || '"' AS session_id FROM pages""",
)
def stream_windowed_sessions(t: Tables) -> DataFrame:
    """Session ids of a stream that drops repeats while their state lives."""
    pages = pageviews.parsed_pages(log_lines(stream_of(t, "events")))
    ids = pageviews.windowed_sessions(pages, "1 hour").select("session_id")
    return batches.append_available(t.spark, ids).distinct()


@query(
    "stream_text_folder",
    r"""
    WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS text FROM documents),
    cut AS (
      SELECT CASE WHEN length(text) = 0 THEN ['']
                  WHEN length(rtrim(text, ' ')) = 0 THEN []
                  ELSE string_split(rtrim(text, ' '), ' ') END AS l FROM lines
    )
    SELECT word, count(*) AS n FROM (SELECT unnest(l) AS word FROM cut) GROUP BY word
    """,
)
def stream_text_folder(t: Tables) -> DataFrame:
    """Words of text files as they arrive, one file per batch."""
    folder = work_dir(t.spark, "texts")
    lines = t.documents.where("text is not null").select(F.explode(F.split("text", "\n", -1)).alias("value"))
    lines.write.option("lineSep", "\n").text(folder)
    stream = t.spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", 1).text(folder)
    return batches.sum_batches(wordcount.batch_word_counts(t.spark, stream), ["word"], "count").withColumnRenamed("count", "n")
