"""Packing documents into sequences of one size, shortest pack first over the lengths.

Documents are tokenised and cut into pieces of at most one sequence. Only the
histogram of the piece lengths, one row per length, decides the packs: lengths are
placed longest first, each into the packs with the least in them that still have
room, for all pieces of the length at once. What comes out is a list of patterns
(lengths in one pack) with counts. The pieces of a length are numbered, and a
piece's number says in which copy of which pattern it lies.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.session import cut_lineage

#: Bytes of words and their ids that a task keeps, twice: those met lately and those before.
MEMO_BYTES = 80 << 20
#: Signs that often stand right behind a word.
ENDS = ".,;:!?"
#: Longer texts are encoded in slices of this many characters, without the memo.
LONG_TEXT = 1 << 20

_spaces = re.compile(r"\s ").search
_cut = re.compile(r"\S(?= )").search


class WordEncoder:
    """Ids of whole texts by a tokenizers file, encoding common words once.

    Byte-level pre-tokenisation never lets a token cross from a character into the
    space behind it, so a text may be cut before every space that follows another
    character: the ids of the parts in a row are the ids of the text.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        self.opens[[rank for token, rank in vocabulary.items() if token.startswith("Ġ")]] = True
        self.ends = {sign: self._ids("a" + sign)[1:].tobytes() for sign in ENDS}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}
        self.held = 0

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Encode words, each for its place behind a space, in one go; cut where a token opens with the space."""
        if not words:
            return
        ids = self._ids(" " + " ".join(words))
        cuts = np.flatnonzero(self.opens[ids])
        raw, ends = ids.tobytes(), [*(4 * cuts[1:]).tolist(), 4 * len(ids)]
        if len(ends) != len(words):  # a word that the tokenizer knows as a special token
            for word in words:
                self.memo[word] = self._ids(" " + word).tobytes()
        else:
            start = 0
            for word, stop in zip(words, ends):
                self.memo[word] = raw[start:stop]
                start = stop
        self.held += len(raw) + sum(map(len, words)) + 180 * len(words)  # with what Python objects take

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; none for a null or empty text."""
        if not text:
            return b""
        if len(text) > LONG_TEXT or text[0] == " ":
            return self._whole(text)
        first, *words = text.split(" ")
        # the last word may end with other white space: it is not kept, so no word kept ends so
        last = self._ids(" " + words.pop()).tobytes() if words and (not words[-1] or words[-1][-1].isspace()) else b""
        if first[-1].isspace() and len(first) < len(text):
            return self._whole(text)
        if self.held > MEMO_BYTES:  # words met lately move on, the others are forgotten
            self.memo, self.older, self.held = {}, self.memo, 0
            self.firsts = {}
        new = set(words).difference(self.memo)
        if new:
            older = self.older
            again = {word: older[word] for word in new if word in older}
            self.memo.update(again)
            self.held += 250 * len(again)
            new.difference_update(again)
        if new:
            if _spaces(" ".join(new) + " "):
                return self._whole(text)
            stems = {word: word[:-1] for word in new if word[-1:] in ENDS and "A" <= word[-2:-1] <= "ɏ" and word[-2].isalpha()}
            self._learn([*new.difference(stems), *{stem for stem in stems.values() if stem not in self.memo and stem not in new}])
            for word, stem in stems.items():  # a letter and a sign behind it are never in one token
                self.memo[word] = self.memo[stem] + self.ends[word[-1]]
            self.held += 250 * len(stems)
        begin = self.firsts.get(first)
        if begin is None:
            begin = self.firsts[first] = self._ids(first).tobytes()
            self.held += len(begin) + len(first) + 180
        return begin + b"".join(map(self.memo.__getitem__, words)) + last

    def _whole(self, text: str) -> bytes:
        return b"".join(self._ids(part).tobytes() for part in self._slices(text))

    @staticmethod
    def _slices(text: str) -> Iterator[str]:
        """Parts of about ``LONG_TEXT`` characters, cut before a space that follows another character."""
        start = 0
        while len(text) - start > LONG_TEXT:
            cut = _cut(text, start + LONG_TEXT)
            if cut is None:
                break
            yield text[start : cut.start() + 1]
            start = cut.start() + 1
        yield text[start:]


@lru_cache(maxsize=1)
def _encoder(content: str) -> WordEncoder:
    return WordEncoder(content)


@dataclass(frozen=True)
class Patterns:
    """Packs by pattern: ``lengths[p]`` in the order they lie in, ``counts[p]`` packs of each."""

    lengths: list[tuple[int, ...]]
    counts: list[int]


def shortest_pack_first(histogram: dict[int, int], size: int) -> Patterns:
    """Place ``histogram`` (length: number of pieces) into packs of ``size``.

    Longest lengths first; each piece goes to the pack with the least in it among
    those with room, a new one if there is none. Packs of equal contents are handled
    together, so the work hangs on the lengths and ``size`` alone, not on the number
    of pieces, and at most two patterns are added per length.
    """
    by_room: dict[int, list[list]] = {}  # room left: [[runs of (length, times), count], ...]

    def put(room: int, runs: tuple, length: int, count: int) -> None:
        if runs and runs[-1][0] == length:
            runs = (*runs[:-1], (length, runs[-1][1] + 1))
        else:
            runs = (*runs, (length, 1))
        by_room.setdefault(room - length, []).append([runs, count])

    for length in sorted((n for n in histogram if histogram[n] > 0), reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in by_room if by_room[r]), default=-1)
            if room < length:
                full, rest = divmod(left, size // length)
                for times, count in ((size // length, full), (rest, 1)):
                    if times and count:
                        by_room.setdefault(size - length * times, []).append([((length, times),), count])
                break
            packs = by_room[room]
            while packs and left:
                runs, count = packs.pop()
                used = min(count, left)
                left -= used
                if used < count:
                    packs.append([runs, count - used])
                put(room, runs, length, used)
    found = [(runs, count) for room in sorted(by_room) for runs, count in by_room[room]]
    return Patterns([tuple(n for n, times in runs for _ in range(times)) for runs, _ in found], [count for _, count in found])


class Slots:
    """Where the n-th piece of a length lies: arrays over (pattern, place), sorted by length and number."""

    def __init__(self, patterns: Patterns):
        length, first, sequence, offset = [], [], [], []
        taken: dict[int, int] = {}
        base = 0
        for lengths, count in zip(patterns.lengths, patterns.counts):
            at = 0
            for n in lengths:
                length.append(n)
                first.append(taken.get(n, 0))
                sequence.append(base)
                offset.append(at)
                taken[n] = taken.get(n, 0) + count
                at += n
            base += count
        order = np.lexsort((np.array(first, np.int64), np.array(length, np.int64)))
        self.length, self.first, self.sequence, self.offset = (np.array(x, np.int64)[order] for x in (length, first, sequence, offset))

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and numbers."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            lo, hi = np.searchsorted(self.length, [n, n + 1])
            which = np.flatnonzero(length == n)
            at = lo + np.searchsorted(self.first[lo:hi], number[which], "right") - 1
            sequence[which] = self.sequence[at] + number[which] - self.first[at]
            offset[which] = self.offset[at]
        return sequence, offset


PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, spark: SparkSession, path: str, size: int = 1024, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens)``: whole texts as ids and ``end``, cut at every ``size``.

    ``path`` names a tokenizers file, which the driver reads once and broadcasts. A
    null or empty text is the id ``end`` alone. Rows with null or repeated ids have
    their own pieces each.
    """
    with open(path, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(content.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["id"], batch["text"]):
                ids = encoder.encode(text) + last
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start : 4 * (start + size)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens"]).astype({"id": batch["id"].dtype})

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(cut, f"id {kind}, {PIECE}")


def number_in_length(rows: DataFrame) -> DataFrame:
    """Add ``number``: 0, 1, 2 ... over the rows of each ``length``; ``rows`` must be checkpointed.

    A checkpoint has fixed partitions, so each partition counts its own lengths and
    prefix sums over the partitions say where its numbers begin. No task sees more
    of a length than one partition holds, however common the length is.
    """
    placed = rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    counts = placed.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_part", "length").orderBy("_row")) - 1
    return placed.withColumn("_inside", inside).join(begins, ["_part", "length"]).withColumn("number", F.col("_begin") + F.col("_inside")).drop("_part", "_row", "_inside", "_begin")


def pack(docs: DataFrame, path: str, size: int = 1024, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in exactly one piece, the pieces of a sequence
    lie end to end from offset 0, and a sequence holds at most ``size`` ids. An empty
    table gives an empty result; other columns are not read. Only the histogram, at
    most ``size`` rows, and its patterns, at most two per length and ``size`` places
    each, pass through the driver.
    """
    spark = docs.sparkSession
    cut = cut_lineage(pieces(docs, spark, path, size, end, id_col, text_col))
    histogram = {row.length: row["count"] for row in cut.groupBy("length").count().collect()}
    slots = spark.sparkContext.broadcast(Slots(shortest_pack_first(histogram, size)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = slots.value.place(batch["length"].to_numpy(), batch["number"].to_numpy())
            yield batch.drop(columns="number").assign(sequence_id=sequence, offset=offset)

    kind = dict(docs.dtypes)[id_col]
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", "number"]
    numbered = number_in_length(cut).select(*columns)
    return numbered.mapInPandas(place, f"id {kind}, {PIECE}, sequence_id long, offset long").withColumnRenamed("id", id_col)
