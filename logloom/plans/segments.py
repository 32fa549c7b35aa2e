"""Ordered work inside large groups, cut into segments that run in parallel.

A window over a group that holds a third of the table would run in one task.
When the order of a group starts with something that can be bucketed (the hour
of a timestamp, a score band), each (group, bucket) pair is handled on its own
and a small per-segment table supplies what must be carried across buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.session import cut_lineage

# ``_segment`` is one struct column: struct equality treats null fields as
# equal, and one column lets the window and the join share a single shuffle.


def _tag(df: DataFrame, keys: Sequence[str], bucket: Sequence[Column]) -> DataFrame:
    fields = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    fields += [b.alias(f"b{i}") for i, b in enumerate(bucket)]
    return df.withColumn("_segment", F.struct(*fields))


def _segment_window(n_keys: int, n_buckets: int) -> Window:
    keys = [F.col(f"_segment.k{i}") for i in range(n_keys)]
    order = [F.col(f"_segment.b{i}").asc_nulls_first() for i in range(n_buckets)]
    return Window.partitionBy(*keys).orderBy(*order)


def _global_offsets(counts: DataFrame, n_buckets: int) -> DataFrame:
    # Two levels: sums inside ranges of segments, and the totals of the ranges,
    # one row per partition. The ranges are checkpointed, as a range partitioning
    # that ran again could number its partitions otherwise.
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(f"_segment.b{i}").asc_nulls_first() for i in range(n_buckets)]
    ranged = cut_lineage(counts.repartitionByRange(partitions, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(F.sum("_n").alias("_total"))
    ranges_before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_total").over(ranges_before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return summed.join(F.broadcast(starts), "_range").select("_segment", (F.col("_start") + F.col("_inside")).alias("_before"))


def _offsets(tagged: DataFrame, n_keys: int, n_buckets: int) -> DataFrame:
    counts = tagged.groupBy("_segment").agg(F.count(F.lit(1)).alias("_n"))
    if n_keys == 0:
        return _global_offsets(counts, n_buckets)
    earlier = _segment_window(n_keys, n_buckets).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "_segment", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )


#: Rows of one (group, bucket) from which it is cut further.
CROWDED = 100_000


def refine(
    df: DataFrame, keys: Sequence[str], bucket: Sequence[Column], fine: Column, name: str, limit: int = CROWDED
) -> DataFrame:
    """Add ``name``: ``fine`` in buckets with more than ``limit`` rows, 0 in all others.

    ``fine`` must follow the order inside a bucket; ``[*bucket, name]`` then is a
    bucketing in which no crowded bucket is left whole. The crowded buckets are
    at most one per ``limit`` rows; each is listed once per salt, so that its rows
    also spread over tasks where the list is too large to broadcast.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, min(partitions, limit // 100))
    hashable = F.struct(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind])
    tagged = _tag(df, keys, bucket).withColumn("_salt", F.pmod(F.xxhash64(hashable), F.lit(salts)).cast("int"))
    full = tagged.groupBy("_segment").count().where(F.col("count") > limit)
    crowded = full.select(
        "_segment", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"), F.lit(True).alias("_full")
    )
    joined = tagged.join(crowded, ["_segment", "_salt"], "left")
    return joined.withColumn(name, F.when(F.col("_full"), fine).otherwise(F.lit(0))).drop("_segment", "_salt", "_full")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Sequence[Column],
    order: Sequence[Column],
    name: str = "pos",
) -> DataFrame:
    """Add the 1-based row number per ``keys`` without one task per key.

    ``bucket`` must be a coarsening of ``order``: rows in an earlier bucket come
    earlier in the order (nulls first). The result is the plain ``row_number``.
    """
    tagged = _tag(df, keys, bucket)
    offsets = _offsets(tagged, len(keys), len(bucket))
    local = F.row_number().over(Window.partitionBy("_segment").orderBy(*order))
    return (
        tagged.withColumn("_local", local)
        .join(offsets, "_segment")
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_segment", "_local", "_before")
    )


def assign_parts(
    df: DataFrame, keys: Sequence[str], bucket: Sequence[Column], size: int, name: str = "part"
) -> DataFrame:
    """Cut each group into consecutive parts of about ``size`` rows.

    Whole buckets are kept together, so a part has fewer than ``size`` rows plus
    one bucket; a group of up to ``size`` rows always is part 0.
    """
    tagged = _tag(df, keys, bucket)
    earlier = _segment_window(len(keys), len(bucket)).rowsBetween(Window.unboundedPreceding, 0)
    counts = tagged.groupBy("_segment").agg(F.count(F.lit(1)).alias("_n"))
    parts = counts.select(
        "_segment", F.floor((F.sum("_n").over(earlier) - 1) / size).cast("int").alias(name)
    )
    return tagged.join(parts, "_segment").drop("_segment")


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Sequence[Column],
    order: Sequence[str],
    value: str,
    name: str = "previous",
) -> DataFrame:
    """Add ``lag(value)`` per ``keys`` in ``order``, one task per (key, bucket)."""
    tagged = _tag(df, keys, bucket)
    by_order = F.struct(*[F.col(c) for c in order])
    lasts = tagged.groupBy("_segment").agg(
        F.max_by(F.struct(F.col(value).alias("v")), by_order).alias("_last")
    )
    carried = lasts.select(
        "_segment",
        F.lag("_last").over(_segment_window(len(keys), len(bucket))).alias("_carry"),
    )
    inside = Window.partitionBy("_segment").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    boxed = F.lag(F.struct(F.col(value).alias("v"))).over(inside)
    return (
        tagged.withColumn("_inside", boxed)
        .join(carried, "_segment")
        .withColumn(name, F.coalesce(F.col("_inside"), F.col("_carry"))["v"])
        .drop("_segment", "_inside", "_carry")
    )
