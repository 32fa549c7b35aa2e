"""Stupid-backoff scores of documents, computed as joins with n-gram count tables.

Every run of ``order`` neighbouring words is a row of the exploded corpus. Rows are
dealt by their last word but one, the last word of every context: all n-grams of all
orders that back off to each other, and their contexts, meet in one group. There the
n-gram and context counts are sums, the rows are joined to them and back off in place,
so a row moves once. A pair below the minimal count backs off to the count of its
second word, a join with the word table. Contributions are summed per document.

A word with more rows than a group is dealt by whole contexts instead. Rows of its
n-grams below the minimal count go on to the next shorter order without their first
word and are dealt again; of the others only the counts go on, one row per n-gram and
group. For order 2 both ways are the same.

Frequent n-grams would make groups of any size. Those of one order above
``1 / HOT_PAIRS`` of the corpus are fewer than that number whatever its size; their
exact counts are broadcast, rows of frequent n-grams never move and rows of other
n-grams after a frequent context are dealt by the n-gram. So are the counts of the
``LISTED * HOT_WORDS`` most frequent words, which travel as their short numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.words import mixed
from logloom.session import cut_lineage

HOT_WORDS, HOT_PAIRS = 1 << 15, 1 << 12
#: Words with broadcast counts, as a multiple of ``HOT_WORDS``.
LISTED = 8
BACKOFF = 0.4
#: Words handled at once in a task; rows in a group, about.
BUFFER, GROUP = 1 << 19, 3_000_000
#: Rows of a group that are sorted at once, about.
PIECE = 1 << 15
#: A word is its 39-bit hash with this bit, a listed one its rank by frequency.
COLD = np.uint64(1 << 39)
#: Stands before the first word of a document.
START = COLD - np.uint64(1)
#: Kinds of groups beside the orders: sums of documents, rows that back off in place.
SUMS, WHOLE = 0, 1
NO_ID = np.iinfo(np.int64).min
#: Characters of texts whose words are found at once, about.
CHARS = 1 << 16
_INSIDE = ~np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_PLACES = 64
_NUMBERS = mixed(mixed(mixed(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))))


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The word codes of some texts in a row, and how many each text has.

    A word is the sum of a 64-bit number per byte and place, taken for all words at
    once; longer words than there are places are hashed one by one.
    """
    data = [(text or "").encode("utf-8", "replace").lower() + b" " for text in texts]
    joined = b"".join(data)
    chars = np.frombuffer(joined, np.uint8)
    inside = _INSIDE[chars]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(data), np.int64)
    offsets = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes)
    summed = np.add.reduceat(_NUMBERS[(place & (_PLACES - 1)) << 8 | chars[inside]], offsets)
    for at in np.flatnonzero(sizes > _PLACES):
        summed[at] = xxhash.xxh3_64_intdigest(joined[starts[at] : starts[at] + sizes[at]])
    ends = np.searchsorted(starts, np.cumsum([len(d) for d in data]))
    return (mixed(summed) >> np.uint64(25)) | COLD, np.diff(ends, prepend=0)


def _buffers(batches: Iterator[pd.DataFrame], times: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, lengths and word codes of consecutive documents, ``times`` ``BUFFER`` words or more at a time."""
    ids, lengths, parts, size = [], [], [], 0
    chars = min(CHARS, 8 * times * BUFFER)
    for batch in batches:
        texts = batch["text"].tolist()
        ends = np.cumsum([len(text or "") for text in texts]) // chars
        runs = np.append(0, np.flatnonzero(np.diff(ends, append=-1)) + 1)
        for first, last in zip(runs[:-1], runs[1:]):
            codes, n = _codes(texts[first:last])
            ids.append(batch["id"].to_numpy(np.int64)[first:last])
            lengths.append(n)
            parts.append(codes)
            size += len(codes)
            if size >= times * BUFFER:
                yield np.concatenate(ids), np.concatenate(lengths), np.concatenate(parts)
                ids, lengths, parts, size = [], [], [], 0
    if ids:
        yield np.concatenate(ids), np.concatenate(lengths), np.concatenate(parts)


def _first_words(lengths: np.ndarray) -> np.ndarray:
    """Marks the first word of every document of a buffer."""
    first = np.zeros(int(lengths.sum()), bool)
    starts = np.cumsum(lengths) - lengths
    first[starts[lengths > 0]] = True
    return first


def _places(lengths: np.ndarray) -> np.ndarray:
    """Place of every word of a buffer in its document, from 0."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _grams(codes: np.ndarray, last: np.ndarray, order: int) -> np.ndarray:
    """The n-grams that end at the places ``last`` (order x n-grams)."""
    return np.stack([codes[last - back] for back in range(order - 1, -1, -1)])


def _keys(grams: np.ndarray) -> np.ndarray:
    keys = mixed(grams[0])
    for word in grams[1:]:
        keys = mixed(keys + word)
    return keys


def _numbers(grams: np.ndarray) -> np.ndarray:
    """One number per n-gram of words among the first ``HOT_PAIRS``, which those of frequent n-grams are, -1 for others."""
    listed = grams[0] < HOT_PAIRS
    for word in grams[1:]:
        listed &= word < HOT_PAIRS
    at = np.flatnonzero(listed)
    out, numbers = np.full(grams.shape[1], -1, np.int64), np.zeros(len(at), np.int64)
    for word in grams:
        numbers = (numbers << 15) | word[at].view(np.int64)
    out[at] = numbers
    return out


def _spots(codes: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
    """Where n-grams of words among the first ``HOT_PAIRS`` end."""
    listed, ends = codes < HOT_PAIRS, places >= order - 1
    for back in range(min(order, len(codes))):
        ends[back:] &= listed[: len(codes) - back]
    return np.flatnonzero(ends)


def _find(listed: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which numbers are in a sorted list, and their places in it."""
    hit, place = np.zeros(len(numbers), bool), np.zeros(len(numbers), np.int64)
    if len(listed):
        at = np.flatnonzero(numbers >= 0)
        place[at] = np.minimum(np.searchsorted(listed, numbers[at]), len(listed) - 1)
        hit[at] = listed[place[at]] == numbers[at]
    return hit, place


def word_table(docs: DataFrame) -> DataFrame:
    """``(word, n, followed)``: how often each word occurs, and occurs before another word."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, lengths, codes in _buffers(batches, 4):
            words, place, n = np.unique(codes, return_inverse=True, return_counts=True)
            followed = ~np.append(_first_words(lengths)[1:], True) if len(codes) else np.empty(0, bool)
            before = np.bincount(place[followed], minlength=len(words))
            yield pd.DataFrame({"word": words.view(np.int64), "n": n, "followed": before})

    parts = docs.mapInPandas(count, "word long, n long, followed long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("followed").alias("followed"))


class Frequent:
    """Counts of the most frequent words, by rank, and of the frequent n-grams: fewer than ``HOT_PAIRS`` of each order."""

    def __init__(self, total: int, words: np.ndarray, n: np.ndarray, followed: np.ndarray):
        order = np.lexsort((words, -n))
        self.total, self.words, self.n = total, words[order], n[order]
        with np.errstate(divide="ignore"):
            self.log_n, self.log_followed = np.log(self.n), np.log(followed[order])
        # a word is looked up in its slot; of words that share one the first is there, the others in a list
        slots = (self.words & np.uint64((1 << 21) - 1)).astype(np.int64)
        self.slots = np.full(1 << 21, -1, np.int32)
        self.slots[slots[::-1]] = np.arange(len(words), dtype=np.int32)[::-1]
        others = np.flatnonzero(self.slots[slots] != np.arange(len(words)))
        self.others = others[np.argsort(self.words[others])]
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.hot, self.dealt, self.groups, self.hot_groups = len(words), np.empty(0, np.int64), 1, 1

    def share_out(self, order: int) -> None:
        """Which words have more rows than a group, and the groups of the words that fill a good part of one."""
        rows = 2 * GROUP // order
        if order > 2:
            self.hot = int((self.n > rows).sum())
        own = self.n[self.hot : int((self.n * 16 > rows).sum())]
        hot = int(self.n[: self.hot].sum()) if order > 2 else self.total
        self.groups, self.hot_groups = max(1, -(-(self.total - hot) // rows)), max(1, -(-hot // rows))
        loads = np.full(self.groups, (self.total - hot - own.sum()) / self.groups)
        self.dealt = np.zeros(len(own), np.int64)
        for at, n in enumerate(own.tolist()):
            self.dealt[at] = g = loads.argmin()
            loads[g] += n

    def set_grams(self, order: int, numbers: np.ndarray, n: np.ndarray, followed: np.ndarray) -> None:
        by = np.argsort(numbers)
        with np.errstate(divide="ignore"):
            self.grams[order] = numbers[by], np.log(n[by]), np.log(followed[by])

    def replace(self, codes: np.ndarray) -> np.ndarray:
        """Codes with the listed words replaced by their ranks."""
        out = codes.copy()
        rank = self.slots[codes & np.uint64((1 << 21) - 1)]
        at = np.flatnonzero(rank >= 0)
        if not len(at):
            return out
        hit = self.words[rank[at]] == codes[at]
        out[at[hit]] = rank[at[hit]]
        at = at[~hit]
        if len(self.others) and len(at):
            listed = self.words[self.others]
            place = np.minimum(np.searchsorted(listed, codes[at]), len(listed) - 1)
            hit = listed[place] == codes[at]
            out[at[hit]] = self.others[place[hit]]
        return out

    def contexts(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which contexts are frequent, and the log of how often those come before a word."""
        if len(grams) == 1:
            hit = grams[0] < COLD
            return hit, self.log_followed[grams[0][hit].astype(np.int64)]
        listed, _, log_followed = self.grams[len(grams)]
        hit, place = _find(listed, _numbers(grams))
        return hit, log_followed[place[hit]]

    def settle(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which n-grams are frequent, and the log scores of those."""
        listed, log_n, _ = self.grams[len(grams)]
        hit, place = _find(listed, _numbers(grams))
        return hit, log_n[place[hit]] - self.contexts(grams[:-1, hit])[1]


def frequent(docs: DataFrame, table: DataFrame, order: int = 2, min_count: int = 2) -> Frequent:
    """Exact counts of all frequent words, and of the frequent n-grams of every order from 2 on.

    An n-gram above a share of the corpus is above it in some buffer of words, so
    those frequent in a buffer are candidates and only they are counted again.
    """
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # as many of the most frequent words as fit, by steps of a sixteenth of a power of two
    step = F.floor(F.log2("n") * 16)
    steps = sorted(((r.step, r.words) for r in table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    fit = np.cumsum([words for _, words in steps]) <= LISTED * HOT_WORDS
    lowest = min((at for (at, _), fits in zip(steps, fit) if fits), default=1 << 16)
    hot = table.where(step >= lowest).toPandas()
    found = Frequent(total, hot["word"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(), hot["followed"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(found)
    orders = range(2, order + 1)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = {n: set() for n in orders}
        for _, lengths, codes in _buffers(batches):
            codes, places, often = shared.value.replace(codes), _places(lengths), None
            for n in orders:
                numbers = _numbers(_grams(codes, _spots(codes, places, n), n))
                # only what follows a frequent context can be frequent
                numbers = numbers if often is None else numbers[_find(often, numbers >> 15)[0]]
                found_here, times = np.unique(numbers, return_counts=True)
                often = found_here[times * HOT_PAIRS > len(codes)]
                kept[n].update(often.tolist())
        for n in orders:
            yield pd.DataFrame({"size": n, "gram": np.array(list(kept[n]), np.int64)})

    candidates = docs.mapInPandas(local, "size int, gram long").distinct().toPandas()
    lists = {n: np.sort(candidates["gram"][candidates["size"] == n].to_numpy(np.int64)) for n in orders}
    wanted = docs.sparkSession.sparkContext.broadcast(lists)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {n: np.zeros((2, len(wanted.value[n])), np.int64) for n in orders}
        for _, lengths, codes in _buffers(batches):
            codes, places = shared.value.replace(codes), _places(lengths)
            goes_on = np.append(places[1:] > 0, False)
            for n in orders:
                last = _spots(codes, places, n)
                hit, place = _find(wanted.value[n], _numbers(_grams(codes, last, n)))
                for role, chosen in enumerate((hit, hit & goes_on[last])):
                    totals[n][role] += np.bincount(place[chosen], minlength=totals[n].shape[1])
        for n in orders:
            yield pd.DataFrame({"size": n, "gram": wanted.value[n], "n": totals[n][0], "followed": totals[n][1]})

    counts = docs.mapInPandas(exact, "size int, gram long, n long, followed long").groupBy("size", "gram").agg(F.sum("n").alias("n"), F.sum("followed").alias("followed"))
    grams = counts.where((F.col("n") * HOT_PAIRS > total) & (F.col("n") >= min_count)).toPandas()
    for n in orders:
        own = grams[grams["size"] == n]
        found.set_grams(n, *(own[c].to_numpy(np.int64) for c in ("gram", "n", "followed")))
    return found


def _planes(codes: np.ndarray) -> bytes:
    """The five low bytes of each code, byte by byte: what frequent words share lies together."""
    return np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes()


def _unplanes(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(5, size).T
    return out.reshape(-1).view(np.uint64)


def _bytes(numbers: np.ndarray) -> bytes:
    """Numbers of 8 bytes, byte by byte."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_bytes(data: bytes, kind: type, size: int, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * size, at).reshape(8, size).T).reshape(-1).view(kind)


def _steps(ids: np.ndarray) -> np.ndarray:
    """Ids as differences, which wrap around; ``cumsum`` gives the ids."""
    return np.diff(ids, prepend=np.int64(0))


def _pack(ids: np.ndarray, parts: np.ndarray, runs: np.ndarray, grams: np.ndarray, times: np.ndarray) -> bytes:
    """Rows of documents with what the documents carry, then ``times`` of n-grams that are only counted."""
    sizes = np.array([len(ids), len(times), *grams.shape], np.int64)
    data = [sizes.tobytes(), *(_bytes(x) for x in (_steps(ids.astype(np.int64)), parts.astype(np.float64), runs.astype(np.int64), times.astype(np.int64)))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(data + [_planes(np.ascontiguousarray(word)) for word in grams]))


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    docs, counted, order, size = np.frombuffer(data, np.int64, 4).tolist()
    at, out = 32, []
    for kind, n in ((np.int64, docs), (np.float64, docs), (np.int64, docs), (np.int64, counted)):
        out.append(_from_bytes(data, kind, n, at))
        at += 8 * n
    out[0] = np.cumsum(out[0])
    words = [_unplanes(data[at + 5 * size * i : at + 5 * size * (i + 1)], size) for i in range(order)]
    return (*out, np.stack(words))


def _blocks(kind: int, groups: int, group: np.ndarray, ids, doc, grams, own: int, parts=None, times=None) -> Iterator[dict]:
    """N-grams in packed blocks of their groups; ``doc`` numbers into ``ids``, ``parts`` ride on the first row of each document.

    From ``own`` on n-grams are only counted.
    """
    if (doc[1:] < doc[:-1]).any():
        by = np.concatenate([np.argsort(doc, kind="stable"), np.arange(own, len(group))])
        doc, grams, group = doc[by[:own]], grams[:, by], group[by]
    by = np.argsort(group.astype(np.uint16 if groups < 1 << 16 else np.uint32), kind="stable")
    grams = grams[:, by]
    edges = np.append(0, np.cumsum(np.bincount(group.astype(np.int64), minlength=groups)))
    left = None if parts is None else parts.copy()
    for g in np.flatnonzero(np.diff(edges)):
        at = by[edges[g] : edges[g + 1]]
        rows = np.searchsorted(at, own)
        held = doc[at[:rows]]
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1])[:rows])
        owners, runs = held[first], np.diff(first, append=rows)
        carried = np.zeros(len(owners)) if left is None else left[owners]
        if left is not None:
            left[owners] = 0.0
        counts = np.empty(0, np.int64) if times is None else times[at[rows:] - own]
        yield {"group": (kind << 40) | int(g), "block": _pack(ids[owners], carried, runs, grams[:, edges[g] : edges[g + 1]], counts)}


def _dealt(found: Frequent, ids, doc, grams, parts=None, counted=None, times=None) -> Iterator[dict]:
    """N-grams in groups of their order, by context, after a frequent context by n-gram; ``counted`` are only counted, ``times``."""
    order, own = len(grams), grams.shape[1]
    if counted is not None:
        grams = np.concatenate([grams, counted], axis=1)
    group = _keys(grams[:-1])
    often = found.contexts(grams[:-1])[0]
    group[often] = _keys(grams[:, often])
    group = (group >> np.uint64(20)) % np.uint64(found.hot_groups)
    yield from _blocks(order, found.hot_groups, group, ids, doc, grams, own, parts, times)


def _dealt_whole(found: Frequent, ids, doc, grams) -> Iterator[dict]:
    """N-grams in groups by their last word but one."""
    word = grams[-2]
    group = (_keys(grams[-2:-1]) >> np.uint64(20)) % np.uint64(found.groups)
    at = np.flatnonzero(word < found.hot + len(found.dealt))
    group[at] = found.dealt[word[at].astype(np.int64) - found.hot].astype(np.uint64)
    yield from _blocks(WHOLE, found.groups, group, ids, doc, grams, len(doc))


def _sums(found: Frequent, docs: np.ndarray, sums: np.ndarray) -> Iterator[dict]:
    """Sums of documents, which differ, in groups by document."""
    groups = max(found.groups, found.hot_groups)
    group = (mixed(docs.view(np.uint64)) >> np.uint64(20)) % np.uint64(groups)
    by = np.argsort(group.astype(np.uint32), kind="stable")
    edges = np.searchsorted(group[by], np.arange(groups + 1).astype(np.uint64))
    for g in np.flatnonzero(np.diff(edges)):
        at = by[edges[g] : edges[g + 1]]
        data = _bytes(_steps(docs[at])) + _bytes(sums[at])
        yield {"group": (SUMS << 40) | int(g), "block": zstandard.ZstdCompressor(level=1).compress(data)}


def _summed(blocks: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a group with the sums of all that was sent for them."""
    parts = [zstandard.ZstdDecompressor().decompress(block) for block in blocks]
    docs = np.concatenate([np.cumsum(_from_bytes(p, np.int64, len(p) // 16, 0)) for p in parts])
    sums = np.concatenate([_from_bytes(p, np.float64, len(p) // 16, len(p) // 2) for p in parts])
    docs, owner = np.unique(docs, return_inverse=True)
    return docs, np.bincount(owner, sums, minlength=len(docs))


def _deal(found: Frequent, order: int, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> Iterator[dict]:
    """What a buffer adds to each document by itself, then its n-grams in packed groups."""
    codes = found.replace(codes)
    doc, places = np.repeat(np.arange(len(ids)), lengths), _places(lengths)
    parts = np.zeros(len(ids))
    start = np.flatnonzero(places == 0)
    known = codes[start] < COLD
    np.add.at(parts, doc[start[known]], found.log_n[codes[start[known]].astype(np.int64)] - np.log(found.total))
    open_first = start[~known]
    moved, rest = [], places > 0
    for n in range(2, order + 1):
        # the first words of a document have shorter contexts
        here = places >= n - 1 if n == order else places == n - 1
        last = _spots(codes, places, n)
        last = last[here[last]]
        hit, gain = found.settle(_grams(codes, last, n))
        parts += np.bincount(doc[last[hit]], gain, minlength=len(ids))
        rest[last[hit]] = False
        here &= rest
        if order > 2:
            here[1:] &= codes[:-1] < found.hot
        last = np.flatnonzero(here)
        moved.append((doc[last], _grams(codes, last, n)))
        rest[last] = False
    opened = _rows(ids[doc[open_first]], codes[open_first], np.ones(len(open_first)), ids, parts, lengths)
    opened.loc[opened.index[: len(open_first)], "part"] = -np.log(found.total) if found.total else 0.0
    yield _finished(opened, int(ids[0]))
    for owner, grams in moved:
        yield from _dealt(found, ids, owner, grams)
    last = np.flatnonzero(rest)
    grams = _grams(codes, last, order)
    for back in range(2, order):
        grams[order - 1 - back, places[last] < back] = START
    yield from _dealt_whole(found, ids, doc[last], grams)


_OUT = "doc long, word long, weight double, part double, n long"


def _rows(docs, words, weights, part_docs, parts, ns) -> pd.DataFrame:
    """Open words and finished parts as rows; a finished part has a word no table knows, one per document."""
    return pd.DataFrame(
        {
            "doc": np.concatenate([docs, part_docs]),
            "word": np.concatenate([words.view(np.int64), -1 - np.abs(part_docs // 2)]),
            "weight": np.concatenate([weights, np.zeros(len(part_docs))]),
            "part": np.concatenate([np.zeros(len(docs)), parts]),
            "n": np.concatenate([np.zeros(len(docs), np.int64), ns]),
        }
    )


def _finished(rows: pd.DataFrame, group: int) -> dict:
    """Rows of ``_OUT`` on their way past the joins, in groups below 0."""
    data = _bytes(_steps(rows["doc"].to_numpy())) + b"".join(_bytes(rows[c].to_numpy()) for c in ("word", "weight", "part", "n"))
    return {"group": -1 - (group & 0xFFFFF), "block": zstandard.ZstdCompressor(level=1).compress(data)}


def _unfinished(block: bytes) -> pd.DataFrame:
    data = zstandard.ZstdDecompressor().decompress(block)
    size = len(data) // 40
    kinds = [(c.split()[0], np.float64 if c.endswith("double") else np.int64) for c in _OUT.split(", ")]
    rows = {name: _from_bytes(data, kind, size, 8 * size * i) for i, (name, kind) in enumerate(kinds)}
    return pd.DataFrame({**rows, "doc": np.cumsum(rows["doc"])})


_NONE = np.empty(0, np.int64)


def _opened(docs: np.ndarray, words: np.ndarray) -> pd.DataFrame:
    """Open words as rows of ``_OUT``, by document."""
    by = np.argsort(docs, kind="stable")
    return _rows(docs[by], words[by], np.ones(len(docs)), _NONE, np.empty(0), _NONE)


def _sum_by(keys: np.ndarray, weight: np.ndarray | None) -> np.ndarray:
    """For every row the sum of the weights, or number, of the rows with its key."""
    if weight is None:
        # a key that is alone in its bucket is alone
        bucket = (keys & np.uint64((4 << len(keys).bit_length()) - 1)).view(np.int64)
        at = np.flatnonzero(np.bincount(bucket)[bucket] > 1)
        out, keys = np.ones(len(keys), np.int64), keys[at]
    else:
        at, out = None, np.empty(len(keys))
    by = np.argsort(keys)
    keys = keys[by]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    sizes = np.diff(starts, append=len(keys))
    sums = sizes if weight is None or not len(keys) else np.add.reduceat(weight[by], starts)
    out[by if at is None else at[by]] = np.repeat(sums, sizes)
    return out


def _counted(found: Frequent, grams: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The count of each n-gram, and the log of how often its context comes before a word."""
    count = _sum_by(_keys(grams), weight)
    often, logs = found.contexts(grams[:-1])
    log_followed = np.empty(len(often))
    log_followed[often] = logs
    at = np.flatnonzero(~often)
    log_followed[at] = np.log(_sum_by(_keys(grams[:-1, at]), None if weight is None else weight[at]))
    return count, log_followed


def _backed_off(found: Frequent, min_count: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each n-gram adds, and which leave their last word open; all n-grams after their last context words are here."""
    gain, waits = np.zeros(grams.shape[1]), np.ones(grams.shape[1], bool)
    for n in range(len(grams), 1, -1):
        full = np.flatnonzero(grams[-n] != START)
        count, log_followed = _counted(found, grams[-n:, full] if len(full) < len(gain) else grams[-n:])
        seen = waits[full] & (count >= min_count)
        back = full[waits[full] & ~seen]
        gain[full[seen]] += np.log(count[seen]) - log_followed[seen]
        waits[full[seen]] = False
        gain[back] += np.log(BACKOFF)
        if n > 2:
            known, logs = found.settle(grams[1 - n :, back])
            gain[back[known]] += logs
            waits[back[known]] = False
    ask = np.flatnonzero(waits)
    words = grams[-1, ask]
    gain[ask] -= np.log(found.total)
    known = words < COLD
    gain[ask[known]] += found.log_n[words[known].astype(np.int64)]
    return gain, ask[~known]


def _join_whole(found: Frequent, min_count: int, group: int, blocks: pd.Series) -> list[dict]:
    """N-grams of a group joined to the counts of all orders, which are all in the group: sums and open words."""
    parts = [_unpack(block) for block in blocks]
    doc, grams = np.concatenate([np.repeat(p[0], p[2]) for p in parts]), np.concatenate([p[4] for p in parts], axis=1)
    del parts
    # in pieces, still by last context words, that a processor's cache holds
    pieces = 1 + len(doc) // PIECE
    piece = ((_keys(grams[-2:-1]) & np.uint64(0xFFFFF)) % np.uint64(pieces)).astype(np.uint16)
    by = np.argsort(piece, kind="stable")
    edges = np.concatenate([[0], np.cumsum(np.bincount(piece, minlength=pieces))])
    gain, opened = np.empty(len(doc)), []
    for first, last in zip(edges[:-1], edges[1:]):
        at = by[first:last]
        gain[at], left = _backed_off(found, min_count, grams[:, at])
        opened.append(at[left])
    ask = np.concatenate(opened)
    docs, owner = np.unique(doc, return_inverse=True)
    out = list(_sums(found, docs, np.bincount(owner, gain, minlength=len(docs))))
    return out + [_finished(_opened(doc[ask], grams[-1, ask]), group)] * (len(ask) > 0)


def _join_counts(found: Frequent, min_count: int, blocks: pd.Series) -> tuple[pd.DataFrame, list[dict]]:
    """N-grams of a group joined to the n-gram and context counts of the group: open rows, and blocks of sums and of the next shorter order."""
    parts = [_unpack(block) for block in blocks]
    doc = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
    carriers, carry = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    times = np.concatenate([p[3] for p in parts])
    own = [p[4].shape[1] - len(p[3]) for p in parts]
    grams = np.concatenate([p[4][:, :n] for p, n in zip(parts, own)] + [p[4][:, n:] for p, n in zip(parts, own)], axis=1)
    del parts
    size, weight = len(doc), np.concatenate([np.ones(len(doc), np.int64), times])
    count, log_followed = _counted(found, grams, weight)
    seen = count >= min_count
    gain = np.where(seen, np.log(count) - log_followed, np.log(BACKOFF))[:size]
    ask = np.flatnonzero(~seen[:size])
    shorter = grams[1:]
    if len(shorter) == 1:
        gain[ask] -= np.log(found.total)
        known = shorter[0, ask] < COLD
        gain[ask[known]] += found.log_n[shorter[0, ask[known]].astype(np.int64)]
    else:
        known, logs = found.settle(shorter[:, ask])
        gain[ask[known]] += logs
    ask = ask[~known]
    docs, owner = np.unique(doc, return_inverse=True)
    sums = np.bincount(owner, gain, minlength=len(docs))
    if len(docs):
        sums += np.bincount(np.searchsorted(docs, carriers), carry, minlength=len(docs))
    # a document's sum rides on its first open row, or on a row of its own
    asking, at = np.unique(owner[ask], return_index=True)
    carried = np.zeros(len(docs), bool)
    carried[asking] = True
    if len(shorter) == 1:
        rows = _rows(doc[ask], shorter[0, ask], np.ones(len(ask)), docs[~carried], sums[~carried], np.zeros((~carried).sum(), np.int64))
        total = rows["part"].to_numpy().copy()
        total[at] = sums[carried]
        return rows.assign(part=total), []
    # the counts of the shorter order also hold what was seen here
    rest = np.concatenate([np.flatnonzero(seen[:size]), np.arange(size, len(weight))])
    rest = rest[~found.settle(shorter[:, rest])[0]]
    _, first, place = np.unique(_keys(shorter[:, rest]), return_index=True, return_inverse=True)
    counted = shorter[:, rest[first]]
    times = np.bincount(place, weight[rest], minlength=len(first)).astype(np.int64)
    moved = _dealt(found, docs, owner[ask], shorter[:, ask], sums, counted, times)
    return _rows(_NONE, _NONE, np.empty(0), _NONE, np.empty(0), _NONE), [*_sums(found, docs[~carried], sums[~carried]), *moved]


def score(docs: DataFrame, min_count: int = 2, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """``(id, n_words, log_prob, score)``: natural log of the backoff score, and its mean per word.

    ``S(w | context)``, with the ``order - 1`` words before w (fewer at the start of a
    document), is count(context w) / count(context before a word) for n-grams counted
    at least ``min_count`` times, else 0.4 S(w | context without its first word), and
    count(w) / words without a context. ``order`` is 2, 3 or 4. Documents are scored
    under counts that hold their own words, so with a ``min_count`` of 1 nothing would
    back off. Words are lower-cased runs of non-blanks; all documents are counted.
    Null, empty and blank texts have no words, log_prob 0 and a null score.
    Rows that repeat an id are added up; rows without an id are one row with a null
    id. An empty table gives an empty result; other columns are not read.
    """
    if not 2 <= order <= 4:  # numbers of frequent n-grams have 15 bits a word
        raise ValueError(f"order {order} is not 2, 3 or 4")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    table = cut_lineage(word_table(rows))
    found = frequent(rows, table, order, min_count)
    found.share_out(order)
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, lengths, codes in _buffers(batches):
            yield pd.DataFrame(list(_deal(shared.value, order, ids, lengths, codes)))

    def back_off(n: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def step(rows: pd.DataFrame) -> pd.DataFrame:
            found, kind, out = shared.value, rows["group"].iloc[0] >> 40, []
            if kind == SUMS:
                out = list(_sums(found, *_summed(rows["block"])))
            elif kind == WHOLE:
                out = _join_whole(found, min_count, int(rows["group"].iloc[0]), rows["block"])
            elif kind == n:
                out = _join_counts(found, min_count, rows["block"])[1]
            else:
                return rows
            return pd.DataFrame(out, columns=["group", "block"])

        return step

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        kind = rows["group"].iloc[0] >> 40
        if kind < 0:
            return pd.concat([_unfinished(b) for b in rows["block"]])
        if kind == SUMS:
            docs, sums = _summed(rows["block"])
            return _rows(_NONE, _NONE, np.empty(0), docs, sums, np.zeros(len(docs), np.int64))
        return _join_counts(shared.value, min_count, rows["block"])[0]

    moved = rows.mapInPandas(deal, "group long, block binary")
    for n in range(order, 2, -1):
        moved = moved.groupBy("group").applyInPandas(back_off(n), "group long, block binary")
    joined = moved.groupBy("group").applyInPandas(join, _OUT)
    # the log of a count of 1 adds nothing
    backed = joined.join(table.where("n > 1").select("word", F.col("n").alias("_count")), "word", "left")
    total = F.sum("part") + F.coalesce(F.sum(F.col("weight") * F.log("_count")), F.lit(0.0))
    sums = backed.groupBy("doc").agg(F.sum("n").alias("n_words"), total.alias("log_prob"))
    return sums.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_col),
        "n_words",
        "log_prob",
        F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("score"),
    )
