"""Filters, recodes, de-duplication and merging of messy tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_TAGS = 15


def rows_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def filled(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def shaped(
    df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename, then keep ``columns`` in that order."""
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    return df.select(*columns)


def without_value(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def with_license(df: DataFrame, license_name: str, column: str = "Attribution") -> DataFrame:
    return df.where(F.col(column) == license_name)


def recode(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """Replace values through a small mapping; a value not listed becomes null."""
    cells = [F.lit(x) for pair in mapping.items() for x in pair]
    return df.withColumn(column, F.try_element_at(F.create_map(*cells), F.col(column)))


def split_tags(tags: Column) -> Column:
    """Exact comma split; missing tags count as one empty tag."""
    return F.split(F.coalesce(tags, F.lit("")), ",", -1)


def flag_name(entry: str) -> str:
    return f"is_{entry}"


def tag_flags(
    df: DataFrame, vocabulary: Sequence[str], tags: str = "tags", max_tags: int = MAX_TAGS
) -> DataFrame:
    """Tag count plus one 0/1 flag per vocabulary entry.

    Rows with more than ``max_tags`` tags get no flag: such photos are tagged
    with everything.
    """
    parts = split_tags(F.col(tags))
    few = F.size(parts) <= max_tags
    flags = {
        flag_name(v): F.when(few & F.array_contains(parts, v), 1).otherwise(0) for v in vocabulary
    }
    return df.withColumns({"num_tags": F.size(parts), **flags})


def flag_labels(
    df: DataFrame, vocabulary: Sequence[str], name: str = "AircraftModel"
) -> DataFrame:
    """One row per set flag with its label: upper case, ``B`` before a digit."""
    labels = [(v, ("B" + v if v[:1].isdigit() else v).upper()) for v in vocabulary]
    set_labels = F.array(
        *[F.when(F.col(flag_name(v)) == 1, F.lit(label)) for v, label in labels]
    )
    kept = [c for c in df.columns if c not in {flag_name(v) for v in vocabulary}]
    return df.select(*kept, F.explode(F.array_compact(set_labels)).alias(name))


def photo_columns(df: DataFrame) -> DataFrame:
    """Readable text, the larger image variant and its file name (literal replacements)."""
    plus, blank = F.lit("+"), F.lit(" ")
    return (
        df.withColumn("desc", F.replace(F.col("desc"), plus, blank))
        .withColumn("tags", F.replace(F.coalesce("tags", F.lit("")), plus, blank))
        .withColumnRenamed("ImageURL", "default_image_url")
        .withColumn("ImageURL", large_image(F.col("default_image_url")))
        .withColumn("image_file_name", file_key(F.col("ImageURL")))
    )


def large_image(url: Column) -> Column:
    return F.replace(url, F.lit(".jpg"), F.lit("_b.jpg"))


def file_key(url: Column) -> Column:
    """``md5(url).extension`` where the extension follows the last dot."""
    return F.concat(F.md5(url.cast("binary")), F.lit("."), F.element_at(F.split(url, r"\.", -1), -1))


def min_size(files: DataFrame, kb: int) -> DataFrame:
    return files.where(F.col("length") >= kb * 1024)


def drop_multi_detection(items: DataFrame, detections: DataFrame, key: str) -> DataFrame:
    """Drop items with more than one detection."""
    many = detections.groupBy(key).count().where("count > 1").select(key)
    return items.join(many, key, "left_anti")


def extension(name: Column) -> Column:
    return F.regexp_extract(name, r"\.([^.]*)$", 1)


def allowed_extension(name: Column, extensions: Sequence[str]) -> Column:
    """Case-sensitive test of what follows the last dot; no dot is not allowed."""
    return name.contains(".") & extension(name).isin(*extensions)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_keep(
    df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "first"
) -> DataFrame:
    """One row per key: the first or last in ``order`` (make it total).

    The rank filter lets Spark keep one row per key on the map side already, so
    a key with many copies is reduced before the shuffle.
    """
    direction = {"first": F.asc_nulls_first, "last": F.desc_nulls_last}[keep]
    window = Window.partitionBy(*key).orderBy(*[direction(c) for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where("_rank = 1").drop("_rank")


def merge_previous(
    new: DataFrame,
    old: DataFrame,
    key: Sequence[str],
    prefer: str = "old",
    order: Sequence[str] = (),
) -> DataFrame:
    """Union of two tables with one row per key; ``prefer`` names the winner.

    ``order`` breaks ties inside one table, the last row winning.
    """
    rank = {"old": (0, 1), "new": (1, 0)}[prefer]
    both = union_all(
        new.withColumn("_priority", F.lit(rank[0])), old.withColumn("_priority", F.lit(rank[1]))
    )
    return dedup_keep(both, key, ["_priority", *order], keep="last").drop("_priority")
