"""How quality filters interact, for every order in which they may be applied.

Each document becomes a mask of the filters that it fails, and each part of the
corpus a table of at most 32 mask counts. A part's counts become a decision diagram
with one level per filter: a node splits its documents into those that pass and
those that fail, equal nodes of a level are one. Two neighbouring filters trade
places by a swap of their two levels, so all orders are walked from swap to swap.
In each order the path on which everything passes holds the steps: what leaves it
at a level is what that filter removes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.plans.skew import hot_keys, salted_join
from logloom.session import cut_lineage

#: The filters in the order of their bits; E is the one that needs the other documents.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"


@dataclass(frozen=True)
class Limits:
    """Least words, least per cent of distinct words, most per cent of capitals."""

    words: int = 100
    distinct: int = 80
    capitals: int = 10


def failures(text: str | None, limits: Limits = Limits()) -> int:
    """Bits of the filters A to D that a text fails; a null text is an empty one."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()  # cuts at exactly the bytes 20 and 09-0D
    capitals = len(data) - len(data.translate(None, UPPER))
    failed = (
        len(words) < limits.words,
        100 * len(set(words)) < limits.distinct * len(words),
        100 * capitals > limits.capitals * len(text or ""),
        len(data.translate(None, SYMBOLS)) < len(data),
    )
    return sum(1 << bit for bit, fails in enumerate(failed) if fails)


class Diagram:
    """A decision diagram over mask counts; ``order`` names the filter of each level.

    ``levels[i]`` lists the nodes of level i as (passing, failing) places in level
    i + 1; below the last filter stand the distinct count vectors. ``totals[i]`` has
    the counts that reach each node. A level never holds two equal nodes.
    """

    def __init__(self, counts: np.ndarray, order: Sequence[int]):
        """``counts``: masks x kinds of counts, bit b of a mask for filter b."""
        self.order = list(order)
        below: dict = {}
        places = [below.setdefault(tuple(int(c) for c in counts[self._mask(path)]), len(below)) for path in range(len(counts))]
        self.levels: list[list[tuple[int, int]]] = []
        self.totals = [np.array(list(below), np.int64).reshape(len(below), -1)]
        while len(places) > 1:
            nodes: dict = {}
            half = len(places) // 2  # the two halves differ in the filter of the lowest level left
            places = [nodes.setdefault((places[i], places[i + half]), len(nodes)) for i in range(half)]
            self.levels.insert(0, list(nodes))
            self.totals.insert(0, self._sums(self.levels[0], self.totals[0]))

    def _mask(self, path: int) -> int:
        # bit i of a path: whether the document fails the filter of level i
        return sum(1 << f for level, f in enumerate(self.order) if path >> level & 1)

    @staticmethod
    def _sums(nodes: list[tuple[int, int]], totals: np.ndarray) -> np.ndarray:
        at = np.array(nodes)
        return totals[at[:, 0]] + totals[at[:, 1]]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one; all other levels stay as they are."""
        upper, lower = self.levels[level], self.levels[level + 1]
        nodes: dict = {}
        swapped = []
        for passing, failing in upper:
            (pp, pf), (fp, ff) = lower[passing], lower[failing]
            swapped.append((nodes.setdefault((pp, fp), len(nodes)), nodes.setdefault((pf, ff), len(nodes))))
        self.levels[level], self.levels[level + 1] = swapped, list(nodes)
        self.totals[level + 1] = self._sums(self.levels[level + 1], self.totals[level + 2])
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(filter, counts kept, counts removed) down the path on which everything passes."""
        node = 0
        for level, filter_ in enumerate(self.order):
            passing, failing = self.levels[level][node]
            yield filter_, self.totals[level + 1][passing], self.totals[level + 1][failing]
            node = passing


def swaps(size: int) -> Iterator[int]:
    """Places of neighbours to swap, one after the other, so that every order comes up once.

    The largest item walks through the others to the far end; then the others take
    their own next swap and it walks back.
    """
    if size < 2:
        return
    there, back = list(range(size - 2, -1, -1)), list(range(size - 1))
    others = swaps(size - 1)
    leftward = True
    while True:
        yield from there if leftward else back
        place = next(others, None)
        if place is None:
            return
        yield place + 1 if leftward else place
        leftward = not leftward


def audit_part(counts: np.ndarray, names: str = FILTERS) -> pd.DataFrame:
    """Every order and step of one part; ``counts`` is masks x (documents, good, toxic)."""
    size = len(names)
    diagram = Diagram(counts, range(size))
    walks = {}
    for place in [None, *swaps(size)]:
        if place is not None:
            diagram.swap(place)
        walks["".join(names[f] for f in diagram.order)] = list(diagram.steps())
    shares, fails, alone = Counter(), {}, {}
    for walk in walks.values():
        for step, (filter_, _, removed) in enumerate(walk):
            shares[filter_] += int(removed[0])
            if step == 0:
                fails[filter_] = int(removed[0])  # nothing is gone yet: all that fail it
            if step == size - 1:
                alone[filter_] = int(removed[0])  # all others are passed: only this one fails
    rows = [
        (order, step, int(kept[0]), int(removed[0]), fails[f] - int(removed[0]), alone[f], int(removed[1]), int(removed[2]), shares[f])
        for order, walk in walks.items()
        for step, (f, kept, removed) in enumerate(walk, 1)
    ]
    return pd.DataFrame(rows, columns=["filter_order", "step", *COUNTS])


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failure_masks(
    docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and set of failed filters.

    A document fails E if a row with a smaller id, anywhere in the table, has the same
    text (null texts are empty ones); rows without an id neither fail E nor make others
    fail. An id is good or toxic if any label row says so. Every row counts for itself.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "part": batch["part"],
                    "mask": [failures(t, limits) for t in texts],
                    "digest": [hashlib.sha256(t.encode("utf-8", "replace")).digest() for t in texts],
                }
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
    seen = rows.mapInPandas(look, "id long, part string, mask int, digest binary")
    # repeated rows fall together before anything is joined
    seen = cut_lineage(seen.groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    marks = labels.select(F.col(id_col).cast("long").alias("id"), *(F.coalesce(F.col(c) == 1, F.lit(False)).alias(c) for c in ("quality", "toxic")))
    marks = marks.where("id is not null and (quality or toxic)").groupBy("id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    hot = hot_keys(seen.where("id is not null").groupBy("id").count(), "id", "count")
    known = salted_join(seen.where("id is not null"), marks, "id", hot, F.col("digest"), "left").unionByName(
        seen.where("id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    )
    known = known.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # per text at most one row for each part and label; copies need not meet one by one
    texts = known.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("id").alias("first"),
        F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("n_first"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    original = F.col("n_null") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    split = texts.withColumn("least", least).withColumn("kept", original)
    both = split.select(
        "part", "good", "toxic", F.explode(F.array(F.struct("mask", F.col("kept").alias("n")), F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - F.col("kept")).alias("n")))).alias("c")
    )
    of = {kind: F.sum(F.when(F.col(kind), F.col("c.n")).otherwise(0)).alias(kind) for kind in ("good", "toxic")}
    return both.groupBy("part", F.col("c.mask").alias("mask")).agg(F.sum("c.n").alias("n"), of["good"], of["toxic"])


def audit(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    Columns: part, filter_order, step and the counts kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley. ``how`` goes to ``failure_masks``.
    A null part is the empty string and one part with it; an empty table gives no
    rows, empty labels give zeros; other columns are not read.
    """

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((1 << len(FILTERS), 3), np.int64)
        counts[rows["mask"].to_numpy()] = rows[["n", "good", "toxic"]].to_numpy()
        out = audit_part(counts)
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    schema = f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in COUNTS)}"
    return failure_masks(docs, labels, **how).groupBy("part").applyInPandas(walk, schema)


AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), c AS (
  SELECT doc_id, part, length(text) AS chars, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, regexp_matches(text, '[#$%&*|]') AS fails_d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS fails_e
  FROM d
), m AS (
  SELECT part,
    (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT + 4 * (100 * capitals > 10 * chars)::INT
      + 8 * fails_d::INT + 16 * fails_e::INT AS mask,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM c
), t AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL
), l AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)
), p AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM p, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM t, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
