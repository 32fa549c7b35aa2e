"""Nearest neighbours along shifted Hilbert curves.

Each of several orderings projects the vectors by a random rotation, shifts them
and strings them along a Hilbert curve. The curve is cut into ``blocks`` ranges of
about equal numbers of vectors; a query looks through its own range and the two
beside it in every ordering, and what the windows hold is ranked by exact distance.
Ranges are shares of the curve, so the share of vectors that a query meets, and
with it recall, does not fall as the table grows; all windows together measure less
than one distance per vector and query. A table with too few vectors for ranges of
``least`` is one range and every query meets all of it. Range by query tiles of bounded
size keep one busy range, or one vector that is stored very often, off a single task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.hilbert import hilbert_keys
from logloom.session import cut_lineage


@dataclass(frozen=True)
class Curves:
    """Shape of the index; ``sample`` bounds the vectors that the ranges are fitted on.

    Ranges hold ``least`` vectors or more on average, or the table is one range.
    """

    orderings: int = 20
    axes: int = 8
    bits: int = 4
    blocks: int = 64
    least: int = 64
    sample: int = 10_000
    tile_rows: int = 2048
    tile_queries: int = 512


class Index:
    """Projections, shifts and range bounds of every ordering."""

    def __init__(self, sample: np.ndarray, how: Curves):
        rng = np.random.default_rng(7)
        size = sample.shape[1]
        axes = min(how.axes, size)
        self.how, self.centre = how, sample.mean(axis=0)
        spread = float(np.sqrt(((sample - self.centre) ** 2).mean())) or 1.0
        self.step = 6 * spread / (1 << how.bits)
        self.turns = [np.linalg.qr(rng.normal(size=(size, axes)))[0] for _ in range(how.orderings)]
        self.shifts = rng.uniform(0, 1, (how.orderings, axes))
        shares = np.arange(1, how.blocks) / how.blocks
        self.bounds = []
        for k in range(how.orderings):
            keys = np.sort(self._keys(sample, k))
            self.bounds.append(keys[(shares * len(keys)).astype(int)])

    def _keys(self, vectors: np.ndarray, ordering: int) -> np.ndarray:
        half = 1 << (self.how.bits - 1)
        cells = np.floor((vectors - self.centre) @ self.turns[ordering] / self.step + self.shifts[ordering]) + half
        return hilbert_keys(np.clip(cells, 0, 2 * half - 1), self.how.bits)

    def blocks(self, vectors: np.ndarray) -> np.ndarray:
        """Range of each vector in each ordering (orderings x vectors)."""
        return np.stack([np.searchsorted(b, self._keys(vectors, k), "right") for k, b in enumerate(self.bounds)])


def usable(vec_id: str, vector: str) -> Column:
    """Vectors that take part: no null, zero or non-finite ones, none without an id."""
    return F.expr(
        f"{vec_id} is not null and {vector} is not null and size({vector}) > 0 "
        f"and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        f"and exists({vector}, x -> x <> 0)"
    )


def _row_hashes(ids: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """A hash of id and vector, so that an id that has many vectors is dealt out as well."""
    vectors = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw))
    return (ids.astype(np.uint64) ^ vectors) * np.uint64(0x9E3779B97F4A7C15)


def _spread(hashed: np.ndarray, ways: np.ndarray) -> np.ndarray:
    return ((hashed >> np.uint64(33)) % ways.astype(np.uint64)).astype(np.int64)


def _nearest(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest ids of a tile for each of its queries, at their smallest distances."""
    asked = rows["asked"].to_numpy()
    ids = rows["vec_id"].to_numpy()
    vectors = np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(len(rows), -1)
    found = {"query_id": [], "vec_id": [], "score": []}
    by = np.argsort(ids[~asked], kind="stable")
    data, data_ids = vectors[~asked][by], ids[~asked][by]
    if len(data):
        norms = (data * data).sum(axis=1)
        starts = np.flatnonzero(np.append(True, data_ids[1:] != data_ids[:-1]))
        for query, query_id in zip(vectors[asked], ids[asked]):
            rough = norms - 2 * (data @ query)
            rough[data_ids == query_id] = np.inf
            least = rough if len(starts) == len(data) else np.minimum.reduceat(rough, starts)
            few = min(k, len(least)) - 1
            limit = np.partition(least, few)[few]
            slack = 1e-9 * (1 + norms.max() + query @ query)
            at = np.flatnonzero((rough <= limit + slack) & np.isfinite(rough))
            exact = np.sqrt(((data[at] - query) ** 2).sum(axis=1))
            best = np.lexsort((data_ids[at], exact))
            # the first, and so the nearest, row of each id
            best = best[np.sort(np.unique(data_ids[at][best], return_index=True)[1])][:k]
            found["query_id"].append(np.full(len(best), query_id))
            found["vec_id"].append(data_ids[at][best])
            found["score"].append(exact[best])
    return pd.DataFrame({name: np.concatenate(parts) if parts else [] for name, parts in found.items()})


def search(
    vectors: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", how: Curves = Curves()
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each query row.

    ``queries`` marks the query rows; every usable row but the query's own is a
    candidate and is indexed. Ties go to the smaller id. Vectors that are null, zero,
    not finite or hold nulls take no part, nor do those of another length than most
    (the longest of the commonest). Rows that repeat an id are one candidate at their
    smallest distance. A single vector, or none, gives an empty result.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.where(usable(vec_id, vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked")
    )
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    # rows that repeat id and vector are one; they would crowd the other ids out of a tile
    rows = cut_lineage(rows.where(F.size("vector") == common.n).groupBy("vec_id", "vector").agg(F.max("asked").alias("asked")))
    if how.blocks > 1 and rows.count() < how.blocks * how.least:
        how = replace(how, blocks=1, orderings=1)
    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "vector").limit(how.sample).select("vector").toPandas()
    index = rows.sparkSession.sparkContext.broadcast(Index(np.stack(sample["vector"]), how))
    blocks, orderings = how.blocks, how.orderings

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, orderings, blocks), np.int64)
        for batch in batches:
            if len(batch):
                at = index.value.blocks(np.stack(batch["vector"]))
                for role in (0, 1):
                    chosen = at if role == 0 else at[:, batch["asked"].to_numpy(bool)]
                    for o in range(orderings):
                        totals[role, o] += np.bincount(chosen[o], minlength=blocks)
        o, b = np.divmod(np.arange(orderings * blocks), blocks)
        yield pd.DataFrame({"o": o, "b": b, "data": totals[0].ravel(), "asked": totals[1].ravel()})

    # one row per range: a table of fixed size
    sums = rows.mapInPandas(count, "o long, b long, data long, asked long").groupBy("o", "b").agg(F.sum("data").alias("data"), F.sum("asked").alias("asked"))
    held = np.zeros((2, orderings, blocks), np.int64)
    for row in sums.collect():
        held[:, row.o, row.b] = row.data, row.asked
    around = held[1].copy()
    around[:, 1:] += held[1][:, :-1]
    around[:, :-1] += held[1][:, 1:]
    down = np.maximum(1, -(-held[0] // how.tile_rows))
    across = np.maximum(1, -(-around // how.tile_queries))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), 500):
                batch = whole.iloc[start : start + 500]
                stacked = np.stack(batch["vector"])
                at, ids = index.value.blocks(stacked), batch["vec_id"].to_numpy()
                raw = np.array([v.tobytes() for v in stacked], object)
                hashed = _row_hashes(ids, raw)
                is_query = np.flatnonzero(batch["asked"].to_numpy(bool))
                tiles, who, asked = [], [], []

                def add(o, b, rows_at, i, j, role, tiles=tiles, who=who, asked=asked):
                    tiles.append(np.stack([np.full(len(rows_at), o), b, i, j], axis=1))
                    who.append(rows_at)
                    asked.append(np.full(len(rows_at), role))

                everyone = np.arange(len(ids))
                for o in range(orderings):
                    b = at[o]
                    i, wide = _spread(hashed, down[o, b]), across[o, b]
                    for j in range(wide.max()):
                        some = everyone[wide > j]
                        add(o, b[some], some, i[some], np.full(len(some), j), False)
                    for step in (-1, 0, 1):
                        near = at[o, is_query] + step
                        inside = (near >= 0) & (near < blocks)
                        some, b = is_query[inside], near[inside]
                        if not len(some):
                            continue
                        j, tall = _spread(hashed[some], across[o, b]), down[o, b]
                        for i in range(tall.max()):
                            part = tall > i
                            add(o, b[part], some[part], np.full(part.sum(), i), j[part], True)
                tile, who = np.concatenate(tiles), np.concatenate(who)
                yield pd.DataFrame(
                    {**{n: tile[:, c] for c, n in enumerate("obij")}, "vec_id": ids[who], "asked": np.concatenate(asked), "vector": raw[who]}
                )

    placed = rows.mapInPandas(place, "o long, b long, i long, j long, vec_id long, asked boolean, vector binary")
    near = placed.groupBy("o", "b", "i", "j").applyInPandas(lambda tile: _nearest(tile, k), "query_id long, vec_id long, score double")
    once = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
