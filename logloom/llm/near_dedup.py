"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A text becomes its set of word shingles, a set becomes a signature of ``chunks *
width`` MinHash values cut to 16 bits. Two signatures that differ in at most
``chunks * (errors + 1) - 1`` places agree, in one chunk at least, in all places
but ``errors`` (pigeonhole), so each chunk is entered once for every choice of
the places left out and every pair under that distance meets under some key.
Similarity is then confirmed on the full sets.

Texts with equal sets are one class before any pair is made. Classes under one
key are linked through hubs first (one pair per class and round); a pair inside
a component that is already connected needs no test. What the hubs leave is
tested pair by pair, once per pair: no link is lost, no group is expanded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import connected_components
from logloom.llm.words import shingle_set
from logloom.session import cut_lineage, work_dir

#: Shingle-by-hash cells computed at once, so that long texts need bounded memory.
CELLS = 1 << 21


@dataclass(frozen=True)
class NearDedup:
    """``percent`` of the union must be shared; words per shingle; shape of the signature.

    Pairs that met under a key are not tested if more than ``unlike`` places of their
    signatures differ: at a similarity of 0.8 that happens once in 10 ** 8 links.
    """

    percent: int = 80
    shingle: int = 5
    chunks: int = 12
    width: int = 5
    errors: int = 1
    hub_rounds: int = 1
    tile_from: int = 64
    tile: int = 256
    unlike: int = 30

    @property
    def places(self) -> int:
        return self.chunks * self.width

    @property
    def max_distance(self) -> int:
        """The largest signature distance at which no pair can be missed."""
        return self.chunks * (self.errors + 1) - 1


def _factors(places: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 62, places, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(members: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of a non-empty set of 64-bit hashes."""
    step = max(1, CELLS // len(factors))
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(members), step):
        cells = members[start : start + step, None] * factors[None, :]
        np.minimum(least, cells.min(axis=0), out=least)
    # the top bits order the values, so the bits kept are taken below them
    return ((least >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)


def _signed(docs: DataFrame, id_col: str, text_col: str, how: NearDedup) -> DataFrame:
    factors = _factors(how.places)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts, digests, signatures = [], [], []
            for text in batch["text"]:
                members = shingle_set(text, how.shingle)
                counts.append(len(members))
                digests.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                signatures.append(signature(members, factors) if len(members) else None)
            yield pd.DataFrame({"id": batch["id"], "text_hash": batch["text_hash"], "n_shingles": counts, "digest": digests, "sig": signatures})

    return _texts(docs, id_col, text_col).mapInPandas(sign, "id long, text_hash long, n_shingles long, digest binary, sig array<int>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, text_hash)``: an id and the hash of its text name a document, also where an id has several."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))


def _keys(how: NearDedup) -> Column:
    """One key per chunk and choice of places left out."""
    keys = []
    for chunk in range(how.chunks):
        for kept in combinations(range(how.width), how.width - how.errors):
            places = [F.col("sig")[chunk * how.width + place] for place in kept]
            keys.append(F.xxhash64(F.lit(len(keys)), *places))
    return F.array(*keys)


def _distance(left: str, right: str) -> Column:
    return F.size(F.filter(F.arrays_zip(F.col(left).alias("a"), F.col(right).alias("b")), lambda p: p["a"] != p["b"]))


def _class_texts(docs: DataFrame, classes: DataFrame, buckets: DataFrame, folder: str) -> DataFrame:
    """``(rep, text)``: one text of every class that shares a key, written once.

    All texts are shuffled here and nowhere else; the sets of the classes that are
    compared come from this table. Rows that repeat an id and its text are one.
    """
    named = classes.select("rep", "id", "text_hash").join(buckets.select("rep").distinct(), "rep", "left_semi")
    found = docs.join(named, ["id", "text_hash"]).groupBy("rep").agg(F.first("text").alias("text"))
    found.write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def _sets(texts: DataFrame, wanted: DataFrame, how: NearDedup) -> DataFrame:
    """``(rep, members)``: the full shingle sets of the classes ``wanted(rep)``, one row each."""
    size = how.shingle

    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text, size).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"rep": batch["rep"], "members": sets})

    return texts.join(wanted, "rep", "left_semi").mapInPandas(to_sets, "rep long, members array<bigint>")


def _confirm(pairs: DataFrame, texts: DataFrame, how: NearDedup) -> DataFrame:
    """``pairs(a, b)`` with ``linked``, decided on the full shingle sets."""
    sets = _sets(texts, pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), how)
    with_a = pairs.join(sets.withColumnsRenamed({"rep": "a", "members": "of_a"}), "a")
    with_both = with_a.join(sets.withColumnsRenamed({"rep": "b", "members": "of_b"}), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - F.col("shared")
    return (
        with_both.select("a", "b", "of_a", "of_b", shared.alias("shared"))
        .select("a", "b", (F.lit(100) * F.col("shared") >= how.percent * union).alias("linked"))
    )


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """At most one pair per class: with the hub of the keys it shares most."""
    met = buckets.where("rep <> hub").groupBy(F.col("rep").alias("a"), F.col("hub").alias("b")).count()
    return met.groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b"))


def _other_hubs(buckets: DataFrame, links: DataFrame, turn: int) -> DataFrame:
    """Buckets of a later turn: hubs drawn anew, without the classes linked before."""
    hubs = buckets.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep", F.lit(turn))).alias("hub"))
    open_rows = buckets.select("key", "rep").join(links.select(F.col("a").alias("rep")), "rep", "left_anti")
    return open_rows.join(hubs, "key")


def _hub_labels(links: DataFrame) -> DataFrame:
    """``(rep, component)`` of the linked classes after two steps along the hub links, of which each class has one.

    Classes of one label are connected; connected classes may still differ in it,
    which costs a test but loses nothing.
    """
    onward = links.select(F.col("a").alias("b"), F.col("b").alias("_to"))
    return cut_lineage(links.join(onward, "b", "left").select(F.col("a").alias("rep"), F.coalesce("_to", "b").alias("component")))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows(rep, ..)`` with ``component``: a class without a link is its own."""
    return rows.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _open_rows(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, rep, component, largest, n)`` of the keys that span several components."""
    tagged = _labelled(buckets.select("key", "rep"), labels)
    sizes = tagged.groupBy("key", "component").count()
    keys = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("largest"),
        F.sum("count").alias("n"),
        F.count("key").alias("components"),
    )
    return cut_lineage(tagged.join(keys.where("components > 1").drop("components"), "key"))


def _crowds(rows: DataFrame, how: NearDedup) -> DataFrame:
    """``(rep, crowd)``: classes tied together by keys with many classes."""
    big = rows.where(F.col("n") > how.tile_from).select("key", "rep")
    hubs = big.groupBy("key").agg(F.min("rep").alias("hub"))
    met = cut_lineage(big.join(hubs, "key").select("rep", "hub").distinct())
    # a class is tied to one hub; that its hubs belong together is said once for each two hubs
    least = met.groupBy("rep").agg(F.min("hub").alias("least"))
    hub_edges = met.join(least, "rep").select(F.col("hub").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
    found = connected_components(least.select(F.col("rep").alias("u"), F.col("least").alias("v")).union(hub_edges))
    return cut_lineage(
        found.select(F.col("node").alias("rep"), F.col("component").alias("crowd"))
        .union(found.select("component", "component"))
        .distinct()
    )


def _rest_pairs(rows: DataFrame, crowds: DataFrame, signatures: DataFrame, done: DataFrame, how: NearDedup) -> DataFrame:
    """Every pair of unconnected classes under one key that is not ``done(a, b)``, within the distance, once each.

    Of two classes in different components one at least is outside the largest
    component of their key, so only these few rows meet the rows of the key,
    of which there are at most ``tile_from``. Pairs inside a crowd are left out.
    Pairs are numbers alone until each is there once; then the signatures join.
    """
    full = rows.where(F.col("n") <= how.tile_from).join(crowds, "rep", "left")
    outside = full.where("component <> largest").select("key", *(F.col(c).alias(f"{c}_a") for c in ("rep", "component", "crowd")))
    # both outside the largest component: the pair would appear from either side
    once = (F.col("component") == F.col("largest")) | (F.col("rep_a") > F.col("rep"))
    apart = (F.col("component_a") != F.col("component")) & ~F.coalesce(F.col("crowd_a") == F.col("crowd"), F.lit(False))
    pairs = outside.join(full, "key").where(apart & once).select(F.greatest("rep_a", "rep").alias("a"), F.least("rep_a", "rep").alias("b"))
    known = done.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = pairs.distinct().join(known, ["a", "b"], "left_anti")
    for side in "ab":
        pairs = pairs.join(signatures.select(F.col("rep").alias(side), F.col("sig").alias(f"sig_{side}")), side)
    return pairs.where(_distance("sig_a", "sig_b") <= max(how.unlike, how.max_distance)).select("a", "b")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets."""
    columns = np.unique(np.concatenate(left))
    shared = np.zeros((len(left), len(right)), np.float32)
    step = max(1, CELLS // max(len(left), len(right)))
    for start in range(0, len(columns), step):
        part = columns[start : start + step]
        sides = []
        for sets in (left, right):
            marks = np.zeros((len(sets), len(part)), np.float32)
            for row, members in enumerate(sets):
                inside = members[np.searchsorted(members, part[0]) : np.searchsorted(members, part[-1], "right")]
                at = np.searchsorted(part, inside)
                marks[row, at[part[at] == inside]] = 1
            sides.append(marks)
        shared += sides[0] @ sides[1].T
    return shared.astype(np.int64)


def _tree(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of the links ``left[i]``-``right[i]`` that tie together what all of them do, without a circle."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (up := parent.get(node, node)) != node:
            parent[node] = node = parent.get(up, up)
        return node

    kept = []
    for i, (u, v) in enumerate(zip(left.tolist(), right.tolist())):
        u, v = root(u), root(v)
        if u != v:
            parent[max(u, v)] = min(u, v)
            kept.append(i)
    return np.array(kept, np.int64)


def _crowd_links(crowds: DataFrame, labels: DataFrame, texts: DataFrame, how: NearDedup) -> DataFrame:
    """Links between the components of a crowd, tested in tiles of ``tile`` by ``tile`` classes.

    Each class outside the largest component of its crowd meets all classes of
    the crowd; a tile gives the links that tie its components together, fewer than
    there are components, so no pair without a link and no second way to a component
    becomes a row.
    """

    def test(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sets = [[np.asarray(m).view(np.uint64) for m in side["members"]] for side in (left, right)]
        shared = _overlaps(*sets)
        sizes = [np.array([len(m) for m in side]) for side in sets]
        union = sizes[0][:, None] + sizes[1][None, :] - shared
        apart = left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :]
        row, column = np.nonzero(apart & (100 * shared >= how.percent * union))
        tree = _tree(left["component"].to_numpy()[row], right["component"].to_numpy()[column])
        return pd.DataFrame({"a": left["rep"].to_numpy()[row[tree]], "b": right["rep"].to_numpy()[column[tree]]})

    members = _labelled(crowds, labels)
    sizes = members.groupBy("crowd", "component").count()
    shape = sizes.groupBy("crowd").agg(
        F.max_by("component", F.struct("count", "component")).alias("largest"),
        F.ceil(F.sum("count") / how.tile).cast("int").alias("down"),
        F.ceil((F.sum("count") - F.max("count")) / how.tile).cast("int").alias("across"),
    )
    placed = members.join(shape.where("across > 0"), "crowd").withColumn("h", F.abs(F.xxhash64("rep") % (1 << 30)))
    placed = cut_lineage(placed.join(_sets(texts, placed.select("rep"), how), "rep"))
    names = ["crowd", "i", "j", "rep", "component", "members"]
    across, down = F.explode(F.expr("sequence(0, across - 1)")), F.explode(F.expr("sequence(0, down - 1)"))
    same = ["rep", "component", "members"]
    left = placed.where("component <> largest").select("crowd", (F.col("h") % F.col("across")).alias("i"), down, *same)
    right = placed.select("crowd", across, (F.col("h") % F.col("down")).alias("j"), *same)
    right = right.select("crowd", "col", "j", *same)
    sides = [
        side.toDF(*names).select(*(F.col(n).cast("long").alias(n) for n in names[:3]), *(F.col(n).alias(n) for n in same)).groupBy(*names[:3])
        for side in (left, right)
    ]
    return sides[0].cogroup(sides[1]).applyInPandas(test, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: NearDedup = NearDedup(), hashes: bool = False
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Links are pairs whose shingle sets share ``percent`` of their union; the
    component is the smallest id reachable. A null or blank text has an empty
    set and no links. A row with a null id is linked with nothing, has a null
    component and is kept. Rows that repeat an id and its text repeat the result;
    an id with several texts has a row and links for each of them. An empty table
    gives an empty result; other columns are not looked at. ``hashes`` adds
    ``text_hash``, Spark's xxhash64 of the text.
    """
    signed = cut_lineage(_signed(docs, id_col, text_col, how))
    with_set = signed.where("id is not null and n_shingles > 0")
    classes = with_set.groupBy("digest").agg(F.min(F.struct("id", "text_hash", "sig")).alias("first"))
    # a class has a number of its own: its id may stand for other texts, too
    # (nullable, as the optimizer stumbles over unions of columns that never are null)
    number = F.nullif(F.monotonically_increasing_id(), F.lit(-1))
    classes = cut_lineage(classes.select(number.alias("rep"), "digest", "first.id", "first.text_hash", "first.sig"))
    signatures = classes.select("rep", "sig")
    entries = classes.select("rep", F.explode(_keys(how)).alias("key"))
    shared = entries.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last")
    buckets = cut_lineage(entries.join(shared.select("key", "hub"), "key"))

    texts = _class_texts(_texts(docs, id_col, text_col), classes, buckets, work_dir(docs.sparkSession, "class-texts"))
    links = done = None
    for turn in range(how.hub_rounds):
        met = buckets if turn == 0 else _other_hubs(buckets, links, turn)
        tested = cut_lineage(_confirm(cut_lineage(_hub_pairs(met)), texts, how))
        linked, tested = tested.where("linked").select("a", "b"), tested.select("a", "b")
        links, done = (linked, tested) if turn == 0 else (links.union(linked), done.union(tested))
    labels = _hub_labels(links)

    rows = _open_rows(buckets, labels)
    crowds = _crowds(rows, how)
    in_crowds = _crowd_links(crowds, labels, texts, how)
    rest = cut_lineage(_rest_pairs(rows, crowds, signatures, done, how))
    rest_links = _confirm(rest, texts, how).where("linked").select("a", "b")
    links = links.union(rest_links).union(in_crowds)
    labels = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    labels = labels.withColumnRenamed("node", "rep")

    placed = classes.select("rep", "digest", "id").join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    found = placed.join(least, "component").select("digest", "component_id")
    narrow = signed.select("id", "n_shingles", "digest", *(["text_hash"] if hashes else []))
    result = narrow.join(found, "digest", "left").withColumn(
        "component_id", F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id"))
    )
    return result.select(
        F.col("id").alias(id_col),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        *(["text_hash"] if hashes else []),
    )


#: Rows without an id come behind all others; rows of one text among them are one document.
NO_ID = 1 << 62


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: NearDedup = NearDedup()) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, all columns as they are.

    A document is an id and a text. Of each group the one with the smallest id stays
    (of several texts under that id: the one with the smallest hash), once. Rows
    without an id take part behind all others. Null and blank texts are linked with
    nothing and all stay.
    """
    names = docs.columns
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64(text_col), F.lit(NO_ID - 1)))
    rows = docs.select(F.struct(*names).alias("row"), key.alias("_id"), F.col(text_col).alias("_text"))
    found = near_duplicates(rows, "_id", "_text", how, hashes=True).where("n_shingles > 0")
    keys = cut_lineage(found.groupBy("component_id", "_id", "text_hash").agg(F.count(F.lit(1)).alias("n")))
    first = keys.groupBy("component_id").agg(F.min(F.struct("_id", "text_hash")).alias("first"))
    stays = F.col("first") == F.struct("_id", "text_hash")
    judged = keys.join(first, "component_id").select("_id", "text_hash", stays.alias("stays"), (F.col("n") > 1).alias("repeated"))
    judged = cut_lineage(judged.where("repeated or not stays"))
    keyed = rows.withColumn("text_hash", F.xxhash64("_text"))
    single = keyed.join(judged.select("_id", "text_hash"), ["_id", "text_hash"], "left_anti").select("row.*")
    if judged.where("stays").isEmpty():
        return single
    again = keyed.join(judged.where("stays"), ["_id", "text_hash"], "left_semi").groupBy("_id", "text_hash")
    return single.union(again.agg(F.first("row").alias("row")).select("row.*"))
