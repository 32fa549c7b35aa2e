"""Mixing sources to target weights, by exact cuts in a random order.

The documents of a source are ordered by a hash of their id and their sizes summed
along that order; the source is repeated in whole epochs as far as its target
allows and the next epoch is cut where the running sum meets the target. The order
is split into ranges of the hash, whose sums give each range its start, so a source
of any size is summed by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.session import cut_lineage

#: Documents of one source in one range of the hash, about.
ROWS_PER_RANGE = 2_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """``(source, source_size, n, target)`` per source of ``sizes(source, size)``.

    Weights repeat over the sources in code-point order, null last. Targets share
    ``share`` of all words by weight; what exceeds ``cap`` times a source is shared
    again among the others. Sorted by how soon they fill up, the sources before
    the first that does not fill up are exactly those at their cap.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    # one row per source: the windows over all of them are small
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((number - 1) % len(weights) + 1).cast("int"))
    rows = total.select("*", number.alias("_number"), weight.alias("_weight"))
    rows = rows.withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("_cap") / F.col("_weight"), "_number")
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    from_here = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    rows = rows.withColumn("_level", (budget - before) / from_here).withColumn("_place", F.row_number().over(order))
    open_level = F.when(F.col("_cap") > F.col("_level") * F.col("_weight"), F.struct("_place", "_level"))
    rows = rows.withColumn("_first", F.min(open_level).over(everything))
    filled = F.col("_first").isNull() | (F.col("_place") < F.col("_first._place"))
    target = F.when(filled, F.col("_cap")).otherwise(F.col("_first._level") * F.col("_weight"))
    return rows.select("source", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``(id, size, source_size, target, taken)`` of every row of ``docs``.

    ``taken`` counts the words that the mix takes of a document, repeats included;
    over a source it adds up to the target without its fraction. Null texts have
    size 0; a null source is a source, the last one; null ids come last in the
    order. Rows that repeat an id count each for themselves (which of them the cut
    reaches first is settled by their size). A source without words takes none;
    an empty table gives an empty result; other columns are not read.
    """
    sizes = cut_lineage(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")
        )
    )
    per_source = targets(sizes, weights, share, cap)
    whole = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(F.lit(0).cast("long"))
    plan = per_source.withColumn("_epochs", epochs).withColumn("_rest", whole - F.col("_epochs") * F.col("source_size"))
    plan = plan.withColumn("_ranges", F.ceil(F.col("n") / ROWS_PER_RANGE)).withColumnRenamed("source", "_source")
    key = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    keyed = sizes.withColumn("_key", key).join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "n")
    spot = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    # the source and the range as one struct: null sources are equal in it
    keyed = keyed.withColumn("_range", F.struct("source", F.floor(spot * F.col("_ranges")).alias("at")))
    sums = keyed.groupBy("_range").agg(F.sum("size").alias("_size"))
    earlier = Window.partitionBy(F.col("_range.source")).orderBy(F.col("_range.at")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy("_key", F.col("id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, "_range")
    left = F.col("_rest") - F.col("_start") - F.col("_inside")
    extra = F.least(F.greatest(left, F.lit(0)), F.col("size"))
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("_epochs") * F.col("size") + extra).cast("long").alias("taken"),
    )


MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS number
  FROM sizes GROUP BY source
), w AS (
  SELECT *, CASE (number - 1) % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END AS weight, source_size * 2e0 AS top FROM s
), lev AS (
  SELECT *, row_number() OVER o AS place,
    ((sum(source_size) OVER ())::BIGINT * 1.5e0
      - coalesce(sum(top) OVER (ORDER BY top / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
    / sum(weight) OVER (ORDER BY top / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY top / weight, number)
), fst AS (
  SELECT min(place) AS place, min_by(level, place) AS level FROM lev WHERE top > level * weight
), t AS (
  SELECT lev.source, source_size,
    CASE WHEN fst.place IS NULL OR lev.place < fst.place THEN top ELSE fst.level * weight END AS target
  FROM lev CROSS JOIN fst
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t
), r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs,
    floor(p.target)::BIGINT - p.epochs * p.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sizes d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + least(greatest(rest - before, 0), size))::BIGINT AS taken
FROM r
"""


def mixed_copies(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, at least in part; columns as they are.

    Documents stay whole: the one at the cut of a source counts as taken. Rows are
    told apart by all they hold, so rows with null or repeated ids take part like
    all others; equal rows are taken equally often. Rows without words are left out.
    ``how`` goes to ``mix``.
    """
    names = docs.columns
    rows = docs.select(*names, F.xxhash64(*names).cast("string").alias("_row"))
    mixed = mix(rows.withColumnRenamed("_row", "_mixed_row"), id_col="_mixed_row", text_col=text_col, **how)
    copies = F.expr("(taken + size - 1) div size")
    often = mixed.where("taken > 0").groupBy(F.col("_mixed_row").alias("_row")).agg(F.max(copies).cast("int").alias("_copies"))
    joined = rows.join(often, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return joined.select(*names)
