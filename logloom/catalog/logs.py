"""Sensor readings and access logs, derived from ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.catalog.base import Tables, query
from logloom.functions.weblog import request_uri
from logloom.operators import aggregates, timeseries, weblog
from logloom.plans.segments import number_rows, refine


def cents(value: str) -> Column:
    return F.floor(F.col(value) * 100 + 0.5).cast("bigint")


# --- sensor readings: some times and some readings cannot be read ---


def readings(t: Tables) -> DataFrame:
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select(
        F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(time).alias("Timestamp"),
        F.col("user_id").cast("string").alias("SensorID"),
        F.when(F.col("event_id") % 89 == 0, "oops").otherwise(cents("value").cast("string")).alias("Reading"),
    )


@query(
    "hourly_totals",
    """
    SELECT CASE WHEN event_id % 97 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS date,
           CASE WHEN event_id % 97 = 0 THEN -1 ELSE hour(ts) END AS hour,
           CAST(user_id AS VARCHAR) AS id,
           CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS total
    FROM events WHERE event_id % 89 <> 0
    GROUP BY 1, 2, 3
    """,
)
def hourly_totals(t: Tables) -> DataFrame:
    return timeseries.hourly_totals(readings(t), "Timestamp", "SensorID", "Reading")


@query(
    "sensor_rejects",
    """
    SELECT count(*) AS readings, count(*) FILTER (event_id % 89 = 0) AS rejected FROM events
    """,
)
def sensor_rejects(t: Tables) -> DataFrame:
    return timeseries.rejects(readings(t), "Reading")


# --- access log: lines of text built from the event columns ---

SUFFIXES = [".html", ".js", ".css", ".jpg", ".json", ".png", ""]


def log_lines(events: DataFrame) -> DataFrame:
    """(seq, value): one access-log line per event; every 101st is malformed."""
    event, user = F.col("event_id"), F.col("user_id")
    ip = F.concat_ws(
        ".",
        F.lit("10"),
        (F.floor(user / 65536) % 256).cast("string"),
        (F.floor(user / 256) % 256).cast("string"),
        (user % 256).cast("string"),
    )
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (event % 7 + 1).cast("int"))
    search = F.when(event % 5 == 0, F.concat(F.lit("?k="), event.cast("string"))).otherwise("")
    path = F.concat(F.lit("/"), "event_type", F.lit("/item-"), (event % 500).cast("string"), suffix)
    size = F.when(event % 13 == 0, "-").otherwise(cents("value").cast("string"))
    referer = F.when(event % 4 == 0, "-").otherwise(F.concat(F.lit("http://shop.example/"), "event_type"))
    session = F.when(event % 10 == 0, '"-"').otherwise(
        F.concat(F.lit('"sid='), user.cast("string"), F.lit("."), F.dayofmonth("ts").cast("string"), F.lit('"'))
    )
    line = F.format_string(
        '%s - - [%s +0000] "GET %s%s HTTP/1.1" %s %s "%s" "Agent/%s.0 (X; Y)" %s',
        ip,
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
        path,
        search,
        F.when(F.col("event_type") == "error", "404").otherwise("200"),
        size,
        referer,
        (user % 3).cast("string"),
        session,
    )
    broken = F.concat(F.lit("malformed "), event.cast("string"))
    return events.select(event.alias("seq"), F.when(event % 101 == 0, broken).otherwise(line).alias("value"))


# What a correct parser must find, stated from the columns instead of the lines.
LOG_SQL = """
WITH log AS (
  SELECT event_id AS seq, event_id % 101 <> 0 AS matched, event_id, user_id, ts,
         '10.' || ((user_id // 65536) % 256) || '.' || ((user_id // 256) % 256) || '.' || (user_id % 256) AS ip,
         '/' || event_type || '/item-' || (event_id % 500) ||
           ['.html', '.js', '.css', '.jpg', '.json', '.png', ''][CAST(event_id % 7 + 1 AS INT)] AS uri,
         CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS status,
         CASE WHEN event_id % 13 <> 0 THEN CAST(floor(value * 100 + 0.5) AS BIGINT) END AS bytes,
         CASE WHEN event_id % 4 = 0 THEN '-' ELSE 'http://shop.example/' || event_type END AS referer,
         'Agent/' || (user_id % 3) || '.0 (X; Y)' AS agent,
         CASE WHEN event_id % 10 = 0 THEN '-' ELSE 'sid=' || user_id || '.' || day(ts) END AS sid
  FROM events
), pages AS (
  SELECT * FROM log WHERE matched AND event_id % 7 NOT IN (1, 2, 3, 4)
), visits AS (
  SELECT *, ip || '_' || agent AS visitor, date_trunc('second', ts) AS at_s FROM pages
)
"""


def parsed(t: Tables) -> DataFrame:
    return weblog.parse_access_log(log_lines(t.spread("events")), session=True)


def pages(t: Tables) -> DataFrame:
    return weblog.pages_only(parsed(t))


def visits(t: Tables) -> DataFrame:
    return weblog.with_visitor(pages(t))


@query(
    "access_log_parse",
    LOG_SQL
    + """
    SELECT seq, matched, CASE WHEN matched THEN ip END AS ip,
           CASE WHEN matched THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
           CASE WHEN matched THEN uri END AS requested_resource,
           CASE WHEN matched THEN status END AS status,
           CASE WHEN matched THEN bytes END AS bytes,
           CASE WHEN matched THEN referer END AS referer,
           CASE WHEN matched THEN agent END AS user_agent,
           CASE WHEN matched THEN '"' || sid || '"' END AS session_raw,
           CASE WHEN matched AND sid <> '-' THEN sid END AS session_id
    FROM log
    """,
)
def access_log_parse(t: Tables) -> DataFrame:
    return parsed(t).drop("date_time").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "parse_errors",
    """
    SELECT count(*) AS read, count(*) FILTER (event_id % 101 = 0) AS failed FROM events
    """,
)
def parse_errors(t: Tables) -> DataFrame:
    return aggregates.error_counts(parsed(t), ~F.col("matched"))


@query(
    "request_uri_modes",
    """
    SELECT event_id AS seq,
           CASE WHEN event_id % 3 = 0 THEN '/1.1' ELSE '/a/' || event_id || '.html' END AS uri,
           CASE WHEN event_id % 3 = 0 THEN '/' ELSE '/a/' || event_id || '.html' END AS strict_uri
    FROM events
    """,
)
def request_uri_modes(t: Tables) -> DataFrame:
    path = F.when(F.col("event_id") % 3 == 0, "/").otherwise(
        F.concat(F.lit("/a/"), F.col("event_id").cast("string"), F.lit(".html?q=1"))
    )
    request = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1"))
    return t.events.select(
        F.col("event_id").alias("seq"),
        request_uri(request).alias("uri"),
        request_uri(request, strict=True).alias("strict_uri"),
    )


@query(
    "page_views",
    LOG_SQL + "SELECT uri AS requested_resource, count(*) AS views FROM pages GROUP BY 1",
)
def page_views(t: Tables) -> DataFrame:
    return weblog.page_views(pages(t))


@query(
    "referral_counts",
    LOG_SQL
    + "SELECT referer, uri AS requested_resource, count(*) AS referrals FROM pages GROUP BY 1, 2",
)
def referral_counts(t: Tables) -> DataFrame:
    return weblog.referral_counts(pages(t))


@query("session_ids", LOG_SQL + """SELECT DISTINCT '"' || sid || '"' AS session_id FROM pages""")
def session_ids(t: Tables) -> DataFrame:
    return weblog.session_ids(pages(t))


@query(
    "page_sequences",
    LOG_SQL
    + """
    , crowded AS (
      SELECT *, date_trunc('hour', at_s) AS hour,
        CASE WHEN count(*) OVER (PARTITION BY visitor, date_trunc('hour', at_s)) > 100000
          THEN minute(at_s) * 60 + second(at_s) ELSE 0 END AS fine
      FROM visits
    ), sizes AS (
      SELECT visitor, hour, fine, count(*) AS n FROM crowded GROUP BY ALL
    ), parts AS (
      SELECT visitor, hour, fine,
        CAST(floor((sum(n) OVER (PARTITION BY visitor ORDER BY hour, fine) - 1) / 100000) AS INT) AS part
      FROM sizes
    )
    SELECT v.visitor, part, count(*) AS n_pages, string_agg(uri, '>' ORDER BY at_s, seq) AS pages
    FROM crowded v JOIN parts p ON v.visitor = p.visitor AND v.hour = p.hour AND v.fine = p.fine
    GROUP BY v.visitor, part
    """,
)
def page_sequences(t: Tables) -> DataFrame:
    rows = weblog.page_sequences(visits(t))
    return rows.select(
        "visitor",
        "part",
        F.size("pages").cast("bigint").alias("n_pages"),
        F.array_join("pages", ">").alias("pages"),
    )


@query(
    "page_sequence_parts",
    LOG_SQL
    + """
    , hours AS (
      SELECT visitor, date_trunc('hour', at_s) AS hour, count(*) AS n FROM visits GROUP BY 1, 2
    ), parts AS (
      SELECT visitor, hour, CAST(floor((sum(n) OVER (PARTITION BY visitor ORDER BY hour) - 1) / 10) AS INT) AS part
      FROM hours
    )
    SELECT v.visitor, part, count(*) AS n_pages, string_agg(uri, '>' ORDER BY at_s, seq) AS pages
    FROM visits v JOIN parts p ON v.visitor = p.visitor AND date_trunc('hour', v.at_s) = p.hour
    GROUP BY v.visitor, part
    """,
)
def page_sequence_parts(t: Tables) -> DataFrame:
    """The same sequences when long visits are continued in further rows."""
    rows = weblog.page_sequences(visits(t), max_pages=10)
    return rows.select(
        "visitor",
        "part",
        F.size("pages").cast("bigint").alias("n_pages"),
        F.array_join("pages", ">").alias("pages"),
    )


@query(
    "previous_page",
    LOG_SQL
    + """
    SELECT seq, uri AS requested_resource,
           coalesce(lag(uri) OVER (PARTITION BY visitor ORDER BY at_s, seq), '-') AS previous_page
    FROM visits
    """,
)
def previous_page(t: Tables) -> DataFrame:
    slim = visits(t).select("visitor", "ts", "seq", "requested_resource")
    return weblog.with_previous_page(slim).select("seq", "requested_resource", "previous_page")


@query(
    "events_in_time_order",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events",
)
def events_in_time_order(t: Tables) -> DataFrame:
    events = t.events.select("ts", "event_id")
    hour, second = F.date_trunc("hour", "ts"), F.minute("ts") * 60 + F.second("ts")
    cut = refine(events, [], [hour], second, "_second")
    numbered = number_rows(cut, [], [hour, F.col("_second")], [F.asc("ts"), F.asc("event_id")]).drop("_second")
    return weblog.in_time_order(numbered, "ts", "event_id").select("event_id", "pos")
