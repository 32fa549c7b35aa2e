"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The least number of pieces that the rows of all keys are thought to be cut into.
HOT_SHARE = 500


def hot_keys(counts: DataFrame, key: str, count: str, share: int | None = None) -> DataFrame:
    """``(key, salts)`` of the keys that hold more than ``1/share`` of all rows.

    ``share`` is twice the number of shuffle partitions, so a key is hot once it
    outgrows half an even task, and each of its ``salts`` pieces stays below that.
    The counts add up to the total, hence fewer than ``share`` keys can pass (the
    list is safe to broadcast) and all salts together are fewer than ``2 * share``.
    """
    if share is None:
        partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = max(HOT_SHARE, 2 * partitions)
    total = counts.agg(F.sum(count).alias("_total")).scalar()
    salts = F.ceil(F.col(count) * share / total).cast("int")
    return counts.where(F.col(count) * share > total).select(key, salts.alias("_salts"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: DataFrame,
    spread: Column,
    how: str = "inner",
) -> DataFrame:
    """Equi-join on ``key`` with the rows of each hot key spread over its number of tasks.

    ``hot`` is a table of keys and salts with a proven small size (see ``hot_keys``);
    ``spread`` is a column of ``left`` that varies inside a key. Only the few
    right-hand rows of hot keys are copied, everything else is joined once, so
    the result equals the plain join. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    marks = F.broadcast(hot.groupBy(key).agg(F.max("_salts").alias("_salts")))
    left_salted = (
        left.withColumn("_spread", F.xxhash64(spread))
        .join(marks, key, "left")
        .withColumn("_salt", F.coalesce(F.pmod("_spread", "_salts").cast("int"), F.lit(0)))
        .drop("_salts", "_spread")
    )
    copies = F.when(F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1))
    right_salted = (
        right.join(marks, key, "left")
        .withColumn("_salt", F.explode(copies.otherwise(F.array(F.lit(0)))))
        .drop("_salts")
    )
    return left_salted.join(right_salted, [key, "_salt"], how).drop("_salt")
