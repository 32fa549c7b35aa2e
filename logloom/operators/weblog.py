"""Access-log parsing, page views, referrals, sessions and page sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.dates import parse_log_time
from logloom.functions.weblog import (
    ASSET_SUFFIXES,
    FIELDS,
    is_page,
    line_pattern,
    request_uri,
    session_value,
    visitor_key,
)
from logloom.plans.segments import CROWDED, assign_parts, previous_value, refine

GROUP_MARK = "\x01"
#: A visitor's pages are returned in one row up to this many.
MAX_PAGES = 100_000


def parse_access_log(
    df: DataFrame, line: str = "value", session: bool = False, strict: bool = False
) -> DataFrame:
    """Log lines to columns; ``matched`` is false and the rest null for other lines.

    The raw cells keep their text form; ``ts``, ``status`` and ``bytes`` are
    typed. With ``session`` a tenth field gives ``session_raw`` (as written,
    with its quotes) and ``session_id``.
    """
    pattern = line_pattern(session)
    names = [*FIELDS, *(["session_raw"] if session else [])]
    others = [c for c in df.columns if c != line]
    # One pass over the line: its groups joined by a control character, then cut.
    # The one-element explode keeps later filters from repeating the pattern.
    groups = GROUP_MARK.join(f"${i}" for i in range(1, len(names) + 1))
    cut = F.split(F.regexp_replace(line, f"(?s)^.*?{pattern}.*$", groups), GROUP_MARK, -1)
    cuts = df.select(*df.columns, F.explode(F.array(cut)).alias("_cut"))
    clean = ~F.col(line).contains(GROUP_MARK)
    # a line that holds the control character itself is read group by group
    slow = F.when(
        ~clean & F.col(line).rlike(pattern),
        F.array(*[F.regexp_extract(line, pattern, i) for i in range(1, len(names) + 1)]),
    )
    fast = F.when(clean & (F.size("_cut") == len(names)), F.col("_cut"))
    cells = cuts.select(*others, F.coalesce(fast, slow).alias("_cells"))

    def cell(name: str):
        return F.get("_cells", F.lit(names.index(name)))

    columns = [
        F.nullif(cell("ip"), F.lit("")).alias("ip"),
        cell("time").alias("date_time"),
        parse_log_time(cell("time")).alias("ts"),
        request_uri(cell("request"), strict).alias("requested_resource"),
        cell("status").try_cast("int").alias("status"),
        cell("bytes").try_cast("bigint").alias("bytes"),
        cell("referer").alias("referer"),
        cell("agent").alias("user_agent"),
    ]
    if session:
        columns.append(cell("session_raw").alias("session_raw"))
        columns.append(session_value(cell("session_raw")).alias("session_id"))
    return cells.select(*others, F.col("_cells").isNotNull().alias("matched"), *columns)


def pages_only(log: DataFrame, suffixes: Sequence[str] = ASSET_SUFFIXES) -> DataFrame:
    """Matched lines that request a page; malformed lines are dropped, never fatal."""
    return log.where(F.col("matched") & is_page(F.col("requested_resource"), suffixes))


def page_views(pages: DataFrame) -> DataFrame:
    return pages.groupBy("requested_resource").agg(F.count(F.lit(1)).alias("views"))


def referral_counts(pages: DataFrame) -> DataFrame:
    """Counts per (referer, page); ``-`` is a referer like any other."""
    return pages.groupBy("referer", "requested_resource").agg(F.count(F.lit(1)).alias("referrals"))


def session_ids(pages: DataFrame, column: str = "session_raw") -> DataFrame:
    return pages.select(F.col(column).alias("session_id")).distinct()


def in_time_order(events: DataFrame, ts: str, tie: str) -> DataFrame:
    return events.orderBy(ts, tie)


def _time_bucket(ts: str, tie: str):
    # The hour cuts a visitor's history; rows without a time are cut by position.
    hour = F.date_trunc("hour", F.col(ts))
    block = F.when(F.col(ts).isNull(), F.floor(F.col(tie) / 1_000_000)).otherwise(0)
    return [hour, block]


def _second_of_hour(ts: str):
    return F.minute(ts) * 60 + F.second(ts)


def with_visitor(log: DataFrame, parity: bool = False) -> DataFrame:
    key = visitor_key(F.col("ip"), F.col("user_agent"), parity)
    return log.withColumn("visitor", key)


def page_sequences(
    events: DataFrame,
    visitor: str = "visitor",
    ts: str = "ts",
    tie: str = "seq",
    page: str = "requested_resource",
    max_pages: int = MAX_PAGES,
    crowded: int = CROWDED,
) -> DataFrame:
    """(visitor, part, pages): the pages of each visitor in time order.

    Nearly every visitor is one row, part 0. A visitor with more than
    ``max_pages`` requests is continued in parts 1, 2, …, cut at hours, and at
    seconds in an hour of more than ``crowded`` requests, so that no task holds an
    unbounded list; all parts together are the whole sequence.
    """
    slim = events.select(visitor, ts, tie, page)
    slim = refine(slim, [visitor], _time_bucket(ts, tie), _second_of_hour(ts), "_second", crowded)
    parts = assign_parts(slim, [visitor], [*_time_bucket(ts, tie), F.col("_second")], max_pages)
    step = F.struct(F.col(ts).alias("t"), F.col(tie).alias("s"), F.col(page).alias("p"))
    return (
        parts.groupBy(visitor, "part")
        .agg(F.array_sort(F.collect_list(step)).alias("_steps"))
        .select(visitor, "part", F.transform("_steps", lambda s: s["p"]).alias("pages"))
    )


def with_previous_page(
    events: DataFrame,
    visitor: str = "visitor",
    ts: str = "ts",
    tie: str = "seq",
    page: str = "requested_resource",
    crowded: int = CROWDED,
) -> DataFrame:
    """Add ``previous_page`` of the same visitor; ``-`` for the first request."""
    cut = refine(events, [visitor], _time_bucket(ts, tie), _second_of_hour(ts), "_second", crowded)
    bucket = [*_time_bucket(ts, tie), F.col("_second")]
    linked = previous_value(cut, [visitor], bucket, [ts, tie], page, "previous_page").drop("_second")
    return linked.withColumn("previous_page", F.coalesce("previous_page", F.lit("-")))
