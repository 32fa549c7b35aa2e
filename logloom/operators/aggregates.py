"""Counts, summaries, rankings and top-k; all reduce on the map side first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.arrays import rank_pairs
from logloom.functions.dates import alert_label
from logloom.plans.segments import number_rows


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class, nulls left out, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def latest_date(df: DataFrame, column: str) -> DataFrame:
    """The latest date as ``dd Mon yyyy``."""
    latest = F.max(F.to_date(column)).alias("latest")
    return df.agg(latest).select(alert_label(F.col("latest")).alias("latest_date"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def score_summary(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Mean, population standard deviation and maximum."""
    return df.groupBy(*keys).agg(
        F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.max(score).alias("best")
    )


def mismatch_percent(df: DataFrame, predicted: str, label: str) -> DataFrame:
    """Share of rows, in percent, whose prediction differs; nulls compare as values."""
    differs = ~F.col(predicted).eqNullSafe(F.col(label))
    return df.agg((F.avg(differs.cast("int")) * 100).alias("mismatch_pct"))


def largest_box(
    boxes: DataFrame, frame: str, order: str | Sequence[str], frames: DataFrame | None = None
):
    """The box with the largest area per frame; the earliest one wins ties.

    ``order`` is one numeric column or several, the most important first. ``frames`` lists all frames; those without a box get -1 in every field.
    """
    sides = ["x", "y", "w", "h"]
    earliest = [-F.col(c) for c in ([order] if isinstance(order, str) else order)]
    best = boxes.groupBy(frame).agg(
        F.max_by(F.struct(*sides), F.struct(F.col("w") * F.col("h"), *earliest)).alias("_b")
    )
    best = best.select(frame, *[F.col(f"_b.{s}").alias(s) for s in sides])
    if frames is None:
        return best
    return frames.select(frame).distinct().join(best, frame, "left").fillna(-1, subset=sides)


def size_of(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def error_counts(df: DataFrame, failed: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("read"), F.count_if(failed).alias("failed"))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order (top-n per task, then merged)."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """At most ``k`` rows per group with their rank.

    The rank limit is applied before the shuffle as well, so a large group sends
    at most ``k`` rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def ranked_by_score(
    df: DataFrame, score: str, tie: Sequence[str], name: str = "rank", bands: int = 1000
) -> DataFrame:
    """Rank 1..n by falling score, over the whole table.

    Scores are cut into bands that are ranked in parallel; ``bands`` is the
    number of bands per unit of score.
    """
    # NaN sorts above every number, so it has a band before the first
    band = F.when(F.isnan(score), F.lit(-(2**63)).cast("long")).otherwise(-F.floor(F.col(score) * bands))
    order = [F.desc_nulls_first(score), *[F.asc_nulls_first(t) for t in tie]]
    return number_rows(df, [], [band], order, name)


def rank_predictions(df: DataFrame, names: str, probs: str, keys: Sequence[str]) -> DataFrame:
    """One row per (key, name), the most probable first; ties keep their position."""
    pairs = rank_pairs(F.col(names), F.col(probs))
    rows = df.select(*keys, F.posexplode(pairs).alias("_pos", "_pair"))
    return rows.select(
        *keys,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_pair.name").alias("name"),
        F.col("_pair.prob").alias("prob"),
    )
