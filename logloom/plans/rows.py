"""Array elements as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A plain explode makes Spark add a test for empty arrays, which is moved below
# the projection that builds the array: a costly pattern would run three times
# per row. The outer form has no such test; its null rows are dropped afterwards.


def elements(df: DataFrame, keep: list[str | Column], array: str | Column, name: str) -> DataFrame:
    """``keep`` and one row per non-null element of ``array``."""
    rows = df.select(*keep, F.explode_outer(array).alias(name))
    return rows.where(F.col(name).isNotNull())


def numbered_elements(
    df: DataFrame, keep: list[str | Column], array: str | Column, pos: str, name: str
) -> DataFrame:
    """The same with the zero-based position of each element."""
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, name))
    return rows.where(F.col(name).isNotNull())
