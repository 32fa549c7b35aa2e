"""Key, approximate-string and address-range joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.cleaning import dedup_keep, union_all
from logloom.plans.skew import hot_keys, salted_join
from logloom.plans.spread import widen


def inner_on(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return left.join(right, keys, "inner")


def keep_listed(df: DataFrame, listed: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return df.join(listed, keys, "left_semi")


def exclude_listed(df: DataFrame, listed: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return df.join(listed, keys, "left_anti")


def attach(df: DataFrame, computed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join of a computed column on a unique row key."""
    return df.join(computed, key, "left")


def missing_from(df: DataFrame, stores: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows whose key is in none of the stores."""
    return df.join(union_all(*[s.select(key) for s in stores]), key, "left_anti")


def present_in(df: DataFrame, stores: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows whose key is already in some store."""
    return df.join(union_all(*[s.select(key) for s in stores]), key, "left_semi")


def lookup_first(
    urls: DataFrame, table: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Attributes of the first matching row (in ``order``) for every key."""
    firsts = dedup_keep(table.select(key, *columns, *order), [key], order, keep="first")
    return urls.join(firsts.select(key, *columns), key, "inner")


# --- approximate strings -------------------------------------------------

#: Up to this length names are matched through their shortened variants.
VARIANT_LENGTH = 64


def _shorter(state: Column) -> Column:
    # the variant without one more character, at or after the last cut: every
    # choice of characters is made once
    text, start, n = state["v"], state["p"], F.length(state["v"])
    cuts = F.transform(
        F.sequence(start, n),
        lambda i: F.struct(
            F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1, n)).alias("v"),
            i.alias("p"),
        ),
    )
    return F.when(start <= n, cuts).otherwise(F.array().cast("array<struct<v:string,p:int>>"))


def _variants(text: Column, depth: int) -> Column:
    # Two strings within ``depth`` edits (adjacent swaps included) share a
    # string that each reaches by at most ``depth`` deletions.
    level = F.array(F.struct(text.alias("v"), F.lit(1).alias("p")))
    levels = [level]
    for _ in range(depth):
        level = F.flatten(F.transform(level, _shorter))
        levels.append(level)
    return F.array_distinct(F.transform(F.concat(*levels), lambda s: F.xxhash64(s["v"])))


def _piece_key(n: Column, piece: Column, text: Column) -> Column:
    return F.xxhash64(n, piece, text)


def _bounds(n: Column, piece: Column, pieces: int) -> tuple[Column, Column]:
    start = F.floor(piece * n / pieces)
    return start, F.floor((piece + 1) * n / pieces) - start


def _pieces(text: Column, depth: int) -> Column:
    # 2*depth+1 pieces: an edit touches at most two, so one stays whole.
    count, n = 2 * depth + 1, F.length(text)

    def key(p):
        start, size = _bounds(n, p, count)
        return _piece_key(n, p.cast("int"), F.substr(text, (start + 1).cast("int"), size.cast("int")))

    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), key)


def _piece_probes(text: Column, depth: int) -> Column:
    # Every length, piece and shift under which a longer name can contain a piece.
    count, m = 2 * depth + 1, F.length(text)

    def key(code):
        n = (m - depth + code % count).cast("int")
        piece = F.floor(code / count) % count
        shift = F.floor(code / (count * count)) - depth
        start, size = _bounds(n, piece, count)
        at = (start + shift + 1).cast("int")
        inside = (n > VARIANT_LENGTH) & (at >= 1)
        return F.when(inside, _piece_key(n, piece.cast("int"), F.substr(text, at, size.cast("int"))))

    codes = F.sequence(F.lit(0), F.lit(count**3 - 1))
    return F.array_distinct(F.array_compact(F.transform(codes, key)))


#: Characters that one block of the distance table may hold.
BLOCK_CHARACTERS = 2_000_000


def _characters(texts: list[str], width: int) -> np.ndarray:
    return np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width)


def _banded(left: list[str], right: list[str], limit: int) -> np.ndarray:
    # column t of the band is the cell (i, i + t - limit) of the edit table
    n_left, n_right = (np.array([len(x) for x in side]) for side in (left, right))
    rows = int(n_left.max())
    a = _characters(left, rows + 1)
    b = _characters(right, max(int(n_right.max()), rows + limit) + 1)
    far = limit + 1
    bands = 2 * limit + 1
    end = n_right - n_left + limit
    inside = (end >= 0) & (end < bands)
    place = np.clip(end, 0, bands - 1)
    every = np.arange(len(left))
    found = np.full(len(left), far)
    before = np.full((len(left), bands), far)
    last = np.full((len(left), bands), far)
    for j in range(limit + 1):
        last[:, limit + j] = j
    found[n_left == 0] = last[every, place][n_left == 0]
    for i in range(1, rows + 1):
        row = np.full((len(left), bands), far)
        for t in range(max(0, limit - i), bands):
            j = i + t - limit
            if j == 0:
                row[:, t] = min(i, far)
                continue
            best = last[:, t] + (a[:, i - 1] != b[:, j - 1])
            if t + 1 < bands:
                best = np.minimum(best, last[:, t + 1] + 1)
            if t > 0:
                best = np.minimum(best, row[:, t - 1] + 1)
            if i > 1 and j > 1:
                swapped = (a[:, i - 1] == b[:, j - 2]) & (a[:, i - 2] == b[:, j - 1])
                best = np.where(swapped, np.minimum(best, before[:, t] + 1), best)
            row[:, t] = np.minimum(best, far)
        done = n_left == i
        found[done] = row[every, place][done]
        before, last = last, row
    return np.where(inside, found, far)


def swap_aware_distance(limit: int) -> Callable[[Column, Column], Column]:
    """Edit distance where an adjacent swap costs 1; ``limit + 1`` stands for all above ``limit``.

    Only the ``2 * limit + 1`` diagonals that can matter are computed, for a block of
    pairs at a time; pairs of like length share a block of bounded size.
    """

    @F.pandas_udf("int")
    def distances(left: pd.Series, right: pd.Series) -> pd.Series:
        size = left.str.len().to_numpy(dtype=np.int64)
        out = np.empty(len(left), dtype=np.int32)
        order = np.argsort(size, kind="stable")[::-1]
        start = 0
        while start < len(order):
            wide = int(size[order[start]]) + 2 * limit + 2
            block = order[start : start + max(1, BLOCK_CHARACTERS // wide)]
            out[block] = _banded(left.iloc[block].tolist(), right.iloc[block].tolist(), limit)
            start += len(block)
        return pd.Series(out)

    # keeps Spark from moving the comparison below the de-duplication of pairs
    return distances.asNondeterministic()


def _alike(max_dist: int) -> Column:
    # a swap is two plain edits, so the plain distance is at most twice the other
    near = F.abs(F.length("_left") - F.length("_right")) <= max_dist
    return near & (F.levenshtein(F.col("_left"), F.col("_right"), 2 * max_dist) >= 0)


def _keyed(names: DataFrame, group: str, name: str, alias: str, keys: Column, *others: str) -> DataFrame:
    return widen(names).select(F.col(group).alias("_g"), F.col(name).alias(alias), *others, F.explode(keys).alias("_key"))


def fuzzy_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    group: str,
    right_order: str,
    max_dist: int = 2,
) -> DataFrame:
    """Left rows with the nearest right name of their group within ``max_dist``.

    Adds ``matched`` and ``distance``; of equally near names the first in
    ``right_order`` wins and unmatched rows are dropped. Equal names are joined
    first. Of the others only distinct names are compared, and only those that
    share a key which every pair within ``max_dist`` must share, so no group is
    compared with itself in full. A piece that many long names have in common is
    salted by its count; length and plain distance sort pairs out before the
    exact distance sees them.
    """
    known = F.col(group).isNotNull()
    names = left.where(F.col(left_on).isNotNull() & known).groupBy(group, left_on).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    targets = right.where(F.col(right_on).isNotNull() & known).groupBy(group, right_on).agg(
        F.min(right_order).alias("_order")
    )
    same = targets.select(group, F.col(right_on).alias(left_on))
    equal = names.join(same, [group, left_on], "left_semi")
    others = names.join(same, [group, left_on], "left_anti")

    n_left, n_right = F.length(left_on), F.length(right_on)
    short = _keyed(
        others.where(n_left <= VARIANT_LENGTH + max_dist), group, left_on, "_left", _variants(F.col(left_on), max_dist)
    ).join(
        _keyed(targets.where(n_right <= VARIANT_LENGTH), group, right_on, "_right", _variants(F.col(right_on), max_dist), "_order"),
        ["_g", "_key"],
    )
    pieces = _keyed(
        targets.where(n_right > VARIANT_LENGTH), group, right_on, "_right", _pieces(F.col(right_on), max_dist), "_order"
    ).select(F.struct("_g", "_key").alias("_piece"), "_right", "_order")
    probes = _keyed(
        others.where(n_left > VARIANT_LENGTH - max_dist), group, left_on, "_left", _piece_probes(F.col(left_on), max_dist)
    ).select(F.struct("_g", "_key").alias("_piece"), "_g", "_left")
    crowded = hot_keys(probes.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")), "_piece", "_n")
    long = salted_join(probes, pieces, "_piece", crowded, F.col("_left"))

    columns = ["_g", "_left", "_right", "_order"]
    pairs = (
        short.select(columns)
        .unionByName(long.select(columns))
        .where(_alike(max_dist))
        .distinct()
        .withColumn("_dist", swap_aware_distance(max_dist)("_left", "_right"))
        .where(F.col("_dist") <= max_dist)
    )
    nearest = pairs.groupBy("_g", "_left").agg(
        F.min_by(F.struct("_right", "_dist"), F.struct("_dist", "_order")).alias("_best")
    )
    matches = nearest.select(
        F.struct(F.col("_g").alias("g"), F.col("_left").alias("n")).alias("_name"),
        F.col("_best._right").alias("matched"),
        F.col("_best._dist").alias("distance"),
    )

    def name_key(df):
        return df.withColumn("_name", F.struct(F.col(group).alias("g"), F.col(left_on).alias("n")))

    exact = name_key(equal).select("_name", F.col(left_on).alias("matched"), F.lit(0).alias("distance"))
    hot = hot_keys(name_key(names), "_name", "_rows")
    # maps cannot be hashed; any other columns tell the rows of one name apart
    spread = F.struct(*[F.col(c) for c, kind in left.dtypes if "map<" not in kind])
    return salted_join(name_key(left), matches.unionByName(exact), "_name", hot, spread).drop("_name")


def area_name(level: Column, adm1: Column, adm2: Column) -> Column:
    """The gazetteer column to match at an administrative level."""
    return F.when(level == 2, adm2).otherwise(adm1)


# --- IPv4 ranges ---------------------------------------------------------


def ip_to_number(ip: Column) -> Column:
    """Dotted quad to a number; null when it is not an IPv4 address."""
    parts = F.transform(F.split(ip, r"\.", -1), lambda p: p.try_cast("bigint"))
    valid = ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & F.forall(parts, lambda p: p.between(0, 255))
    return F.when(valid, F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 256 + p))


def cidr_ranges(blocks: DataFrame, cidr: str = "cidr") -> DataFrame:
    """Add ``prefix``, ``start`` and ``end`` (the base address is masked)."""
    pieces = F.split(cidr, "/", -1)
    size = F.pow(F.lit(2), 32 - F.col("prefix")).cast("bigint")
    base = ip_to_number(F.get(pieces, F.lit(0)))
    return (
        blocks.withColumn("prefix", F.get(pieces, F.lit(1)).try_cast("int"))
        .where(F.col("prefix").between(0, 32) & base.isNotNull())
        .withColumn("start", F.floor(base / size) * size)
        .withColumn("end", F.col("start") + size - 1)
    )


#: Blocks of one prefix length up to which they are broadcast (some 30 MB).
BROADCAST_BLOCKS = 500_000


def _network(ip: Column, prefix: int) -> Column:
    size = 2 ** (32 - prefix)
    return F.floor(ip / size) * size


def geo_ip(
    df: DataFrame, ip: str, blocks: DataFrame, name: str = "country", broadcast_blocks: int = BROADCAST_BLOCKS
) -> DataFrame:
    """Add the country of an address; the longest matching prefix wins, else null.

    There is one equi-join on the network address per prefix length present, at
    most 33. Where every length has at most ``broadcast_blocks`` blocks they are
    broadcast and no row of ``df`` moves. Otherwise the distinct addresses are
    looked up and joined back, frequent ones salted. Rows without a valid address
    pass by the joins. Of equal blocks the smaller country name wins.
    """
    entries = cidr_ranges(blocks).groupBy("prefix", "start").agg(F.min("country").alias("_name"))
    # at most 33 rows
    sizes = {r["prefix"]: r["n"] for r in entries.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).collect()}
    numbered = df.withColumn("_ip", ip_to_number(F.col(ip)))
    small = max(sizes.values(), default=0) <= broadcast_blocks

    def looked_up(rows: DataFrame) -> DataFrame:
        for prefix in sizes:
            table = entries.where(F.col("prefix") == prefix).select(
                F.col("start").alias("_net"), F.struct("_name").alias(f"_hit{prefix}")
            )
            if small:
                table = F.broadcast(table)
            rows = rows.withColumn("_net", _network(F.col("_ip"), prefix)).join(table, "_net", "left").drop("_net")
        hits = [F.col(f"_hit{p}") for p in sorted(sizes, reverse=True)]
        best = F.coalesce(*hits)["_name"] if hits else F.lit(None).cast("string")
        return rows.withColumn(name, best).drop(*[f"_hit{p}" for p in sizes])

    if small:
        return looked_up(numbered).drop("_ip")
    valid = numbered.where(F.col("_ip").isNotNull())
    counts = valid.groupBy("_ip").agg(F.count(F.lit(1)).alias("_n"))
    named = looked_up(counts.select("_ip"))
    spread = F.struct(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind])
    found = salted_join(valid, named, "_ip", hot_keys(counts, "_ip", "_n"), spread)
    without = numbered.where(F.col("_ip").isNull()).withColumn(name, F.lit(None).cast("string"))
    return found.unionByName(without).drop("_ip")
