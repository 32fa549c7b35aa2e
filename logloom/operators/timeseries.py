"""Hourly roll-ups of timestamped readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.dates import day_and_hour, parse_timestamp


def with_reading(df: DataFrame, value: str) -> DataFrame:
    """Readings as BIGINT; an unreadable one is null (and counted by ``rejects``)."""
    return df.withColumn(value, F.col(value).try_cast("bigint"))


def rejects(df: DataFrame, value: str) -> DataFrame:
    """How many readings are there and how many cannot be read."""
    bad = F.col(value).try_cast("bigint").isNull()
    return df.agg(F.count(F.lit(1)).alias("readings"), F.count_if(bad).alias("rejected"))


def hourly_totals(df: DataFrame, ts: str, sensor: str, value: str) -> DataFrame:
    """(date, hour, id, total) of integer readings.

    ``ts`` may be text or a timestamp. A time that cannot be read keeps its
    reading under the key ("", -1, id); an unreadable reading is left out.
    """
    when = F.col(ts)
    if df.schema[ts].dataType.simpleString() == "string":
        when = parse_timestamp(when)
    day, hour = day_and_hour(when)
    return (
        df.select(
            day.alias("date"),
            hour.alias("hour"),
            F.col(sensor).alias("id"),
            F.col(value).try_cast("bigint").alias("_reading"),
        )
        .where("_reading IS NOT NULL")
        .groupBy("date", "hour", "id")
        .agg(F.sum("_reading").alias("total"))
    )
