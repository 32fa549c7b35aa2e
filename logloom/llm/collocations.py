"""Phrase collocations by best-first branch and bound over the corpus.

A phrase of at least ``least`` occurrences scores ``floor(1000 a n / (l r))`` at its
weakest cut. Whatever begins with a word of count f scores at most
``floor(1000 n / f)``: cut behind that word, l is f and r is at least a. The
frontier is the frequent words, rarest and so most promising first. Each round
takes the next slab of them, grows their phrases word by word (a phrase can only be
frequent if its prefix is), scores what survives and compares the 2000th score with
the bound of the words not yet expanded; a language is settled once that bound is
below the score. Phrases are counted in full, from all texts, in every round.

Texts are tokenised once, into a table of word numbers. Membership in the tables
that steer the counting (frequent words, prefixes to grow) is tested against bit
filters of bounded size; a filter may let too much through, never too little, and
counts are always exact, grouped by the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.words import mixed
from logloom.session import cut_lineage, work_dir

#: Everything that ends a piece becomes one byte that UTF-8 never uses.
BREAK = b"\xff"
_TO_BREAK = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
UNKNOWN = "und"


@dataclass(frozen=True)
class Mining:
    """What is asked for (``top``, ``least``, ``longest``) and how it is worked off.

    ``first_share`` of a language's words start the phrases of the first round, and
    ``growth`` times as many those of each further one; ``buffer`` words are counted
    together within a task; a bit filter has at most ``2 ** filter_bits`` bits.
    """

    top: int = 2000
    least: int = 100
    longest: int = 5
    first_share: float = 1 / 16
    growth: int = 4
    buffer: int = 1 << 19
    filter_bits: int = 27


def pieces_as_words(text: str | None) -> list[bytes]:
    """The words of all pieces in lower case, with ``BREAK`` between and behind the pieces."""
    data = (text or "").encode("utf-8", "replace").lower().translate(_TO_BREAK)
    return data.replace(BREAK, b" \xff ").split() + [BREAK]


def word_numbers(words: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit number per word, 0 for ``BREAK``."""
    return np.fromiter((0 if w == BREAK else xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def language_salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()) | 1)


def phrase_keys(columns: list[np.ndarray], salt: np.uint64) -> np.ndarray:
    """A 64-bit hash of the phrases that stand in ``columns`` (first words, second words, ...)."""
    key = mixed(columns[0] + salt)
    for column in columns[1:]:
        key = mixed(key + column)
    return mixed(key)


def _tokenised(docs: DataFrame, lang_col: str, text_col: str, how: Mining, seed: int, folder: str) -> DataFrame:
    """Table of two kinds of rows: runs of whole texts as word numbers, and the word counts of each run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pd.DataFrame]:
            for lang, words in held.items():
                codes, known = pd.factorize(np.array(words, dtype=object))
                numbers = word_numbers(known, seed)
                small = codes.astype("<u2" if len(known) <= 1 << 16 else "<u4")
                yield pd.DataFrame({"lang": [lang], "codes": [small.tobytes()], "numbers": [numbers.tobytes()], "wide": [small.itemsize]})
                real = numbers != 0
                counts = np.bincount(codes, minlength=len(known))[real]
                yield pd.DataFrame({"lang": lang, "word": known[real], "number": numbers[real].view(np.int64), "f": counts})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                words = pieces_as_words(text)
                held.setdefault(lang, []).extend(words)
                size += len(words)
                if size >= how.buffer:
                    for part in flush():
                        yield part.reindex(columns=names)
                    held.clear()
                    size = 0
        for part in flush():
            yield part.reindex(columns=names)

    names = ["lang", "codes", "numbers", "wide", "word", "number", "f"]
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows.mapInPandas(run, "lang string, codes binary, numbers binary, wide int, word binary, number long, f long").write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def _vocabulary(table: DataFrame) -> DataFrame:
    return table.where("word is not null").groupBy("lang", "word", "number").agg(F.sum("f").alias("f"))


def _numbers_clash(vocabulary: DataFrame) -> bool:
    """Whether two words have one number, or a word that of a break."""
    per_number = vocabulary.groupBy("number").agg(F.min("word").alias("lo"), F.max("word").alias("hi"))
    return not per_number.where("lo <> hi or number = 0").isEmpty()


def _words(n: int) -> list[str]:
    return [f"w{i}" for i in range(n)]


@dataclass
class Filter:
    """Bits of a set of phrases; ``holds`` is never False for a member."""

    bits: int
    table: Broadcast

    @classmethod
    def of(cls, phrases: DataFrame, columns: list[str], limit: int) -> Filter:
        """Build from the rows of ``phrases`` (lang and number columns): tasks set bits, Spark unites them.

        At least 64 bits for each phrase as long as that is at most ``2 ** limit``, so
        the table that reaches the driver has a fixed bound.
        """
        bits = min(limit, 6 + max(1 << 10, phrases.count()).bit_length())

        def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = np.zeros(1 << (bits - 6), np.uint64)
            for batch in batches:
                for lang, rows in batch.groupby("lang"):
                    keys = phrase_keys([rows[c].to_numpy().view(np.uint64) for c in columns], language_salt(lang))
                    keys >>= np.uint64(64 - bits)
                    np.bitwise_or.at(found, (keys >> np.uint64(6)).astype(np.int64), np.uint64(1) << (keys & np.uint64(63)))
            at = np.flatnonzero(found)
            yield pd.DataFrame({"at": at, "mask": found[at].view(np.int64)})

        marks = phrases.select("lang", *columns).mapInPandas(mark, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toPandas()
        table = np.zeros(1 << (bits - 6), np.uint64)
        table[marks["at"].to_numpy()] = marks["mask"].to_numpy().view(np.uint64)
        return cls(bits, phrases.sparkSession.sparkContext.broadcast(table))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        keys = keys >> np.uint64(64 - self.bits)
        return (self.table.value[(keys >> np.uint64(6)).astype(np.int64)] >> (keys & np.uint64(63))) & np.uint64(1) != 0


def group_phrases(columns: list[np.ndarray], keys: np.ndarray, before: np.ndarray, after: np.ndarray) -> dict[str, np.ndarray]:
    """Equal phrases as one: count, and the least and largest number of the word before and behind."""
    order = np.argsort(keys, kind="stable")
    cuts = keys[order[1:]] != keys[order[:-1]]
    if any((c[order[1:]] != c[order[:-1]])[~cuts].any() for c in columns):  # two phrases under one key
        order = np.lexsort(columns)
        cuts = reduce(np.logical_or, (c[order[1:]] != c[order[:-1]] for c in columns))
    starts = np.flatnonzero(np.append(True, cuts))
    out = {name: c[order[starts]].view(np.int64) for name, c in zip(_words(len(columns)), columns)}
    out["a"] = np.diff(np.append(starts, len(order)))
    for name, around in (("before", before), ("after", after)):
        neighbours = around[order].view(np.int64)  # signed, as the engine compares them
        out[f"{name}_lo"] = np.minimum.reduceat(neighbours, starts)
        out[f"{name}_hi"] = np.maximum.reduceat(neighbours, starts)
    return out


AROUND = ["before_lo", "before_hi", "after_lo", "after_hi"]


#: Places to keep of those given: (places, words known, codes, salt of the language, size of the phrases).
Choice = Callable[[np.ndarray, np.ndarray, np.ndarray, np.uint64, int], np.ndarray]


def _count(table: DataFrame, sizes: list[int], chosen: Choice, need: Filter) -> DataFrame:
    """Exact counts ``(lang, w0 .., a, ...)`` of the phrases of ``sizes`` words that ``chosen`` lets through.

    Only places of phrases of words in ``need`` are shown to ``chosen``, which treats
    all occurrences of a phrase alike. Shorter phrases are filled up with 0.
    """
    longest = max(sizes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, codes, numbers, wide in zip(batch["lang"], batch["codes"], batch["numbers"], batch["wide"]):
                known, codes = np.frombuffer(numbers, np.uint64), np.frombuffer(codes, f"<u{wide}")
                salt = language_salt(lang)
                usable = ((known != 0) & need.holds(phrase_keys([known], salt)))[codes]
                for size in sizes:
                    if len(codes) <= size:
                        continue
                    starts = len(codes) - size + 1
                    open_ = usable[:starts]
                    for shift in range(1, size):
                        open_ = open_ & usable[shift : starts + shift]
                    at = chosen(np.flatnonzero(open_), known, codes, salt, size)
                    if not len(at):
                        continue
                    columns = [known[codes[at + shift]] for shift in range(size)]
                    # every run ends with a break, which the first place finds before it, too
                    groups = group_phrases(columns, phrase_keys(columns, salt), known[codes[at - 1]], known[codes[at + size]])
                    groups |= {name: np.int64(0) for name in _words(longest)[size:]}
                    yield pd.DataFrame({"lang": lang, **groups}).reindex(columns=names)

    words = _words(longest)
    names = ["lang", *words, "a", *AROUND]
    texts = table.where("codes is not null").select("lang", "codes", "numbers", "wide")
    around = [(F.min if c.endswith("lo") else F.max)(c).alias(c) for c in AROUND]
    counted = texts.mapInPandas(run, f"lang string, {', '.join(f'{c} long' for c in names[1:])}")
    return counted.groupBy("lang", *words).agg(F.sum("a").alias("a"), *around)


def _grown(table: DataFrame, size: int, shorter: DataFrame, frequent: Filter, last: Filter, how: Mining) -> DataFrame:
    """Phrases of ``size`` words with at least ``how.least`` occurrences that grow from ``shorter`` and end in ``last``."""
    before = _words(size - 1)
    prefixes = Filter.of(shorter, before, how.filter_bits)

    def chosen(at, known, codes, salt, size):
        single = phrase_keys([known], salt)
        at = at[last.holds(single)[codes[at + size - 1]]]
        if size == 2:  # the prefix is a word: looked up once per word, not per place
            return at[prefixes.holds(single)[codes[at]]]
        return at[prefixes.holds(phrase_keys([known[codes[at + shift]] for shift in range(size - 1)], salt))]

    grown = _count(table, [size], chosen, frequent).where(F.col("a") >= how.least)
    # the filter may have let other prefixes pass
    return grown.join(shorter.select("lang", *before), ["lang", *before], "left_semi")


def _counted_ends(table: DataFrame, phrases: DataFrame, frequent: Filter, how: Mining) -> DataFrame:
    """``(lang, phrase, a)`` of what is left of ``phrases`` behind each cut, if it has two words or more."""
    longest = how.longest - 1
    if longest < 2:
        return phrases.select("lang", "phrase", F.lit(0).cast("long").alias("a")).where("false")
    ends = phrases.where("size(phrase) > 2").select("lang", "phrase", F.explode(F.expr("sequence(2, size(phrase) - 1)")).alias("n"))
    ends = ends.select("lang", F.expr("slice(phrase, size(phrase) - n + 1, n)").alias("phrase")).distinct()
    filled = F.concat("phrase", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("phrase")))
    ends = cut_lineage(ends.select("lang", "phrase", *(filled[i].alias(w) for i, w in enumerate(_words(longest)))))
    wanted = Filter.of(ends, _words(longest), how.filter_bits)

    def chosen(at, known, codes, salt, size):
        columns = [known[codes[at + shift]] for shift in range(size)]
        return at[wanted.holds(phrase_keys(columns + [np.zeros(len(at), np.uint64)] * (longest - size), salt))]

    counted = _count(table, list(range(2, longest + 1)), chosen, frequent)
    return ends.join(counted, ["lang", *_words(longest)]).select("lang", "phrase", "a")


#: Exact for counts below 10 ** 16: the products fit 38 digits.
SCORE = """cast(
  (cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))
  div (cast(l as decimal(16,0)) * cast(r as decimal(16,0))) as long)"""


def _as_phrases(rows: DataFrame, size: int) -> DataFrame:
    return rows.select("lang", F.array(*_words(size)).alias("phrase"), "a")


def _survivors(rows: DataFrame, size: int, longest: int) -> DataFrame:
    """Phrases inside no longer one of the same count.

    A longer phrase around this one has its count only if every occurrence has one
    and the same word before it, or one and the same behind it.
    """
    if size == longest:
        return rows
    alike = [(F.col(f"{side}_lo") == F.col(f"{side}_hi")) & (F.col(f"{side}_lo") != 0) for side in ("before", "after")]
    return rows.where(~(alike[0] | alike[1]))


def _scored(phrases: DataFrame, cuts: Column, left: DataFrame, right: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, phrase, a, n, weakest)``: the least score over ``cuts`` (first of equal ones) with its l and r."""
    parts = phrases.select("lang", "phrase", "a", F.explode(cuts).alias("k"))
    parts = parts.withColumns({"left": F.expr("slice(phrase, 1, k)"), "right": F.expr("slice(phrase, k + 1, size(phrase))")})
    parts = parts.join(left.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    parts = parts.join(right.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    parts = parts.join(F.broadcast(totals), "lang").withColumn("score", F.expr(SCORE))
    return parts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("weakest"))


@dataclass
class Frontier:
    """Per language: frequent words by rising count in classes, and how far they are expanded."""

    total: dict[str, int]
    classes: dict[str, list[tuple[int, int, int]]]  # (class, least count in it, occurrences)
    done: dict[str, int] = field(default_factory=dict)  # classes expanded
    share: float = 0.0

    def next_slab(self, how: Mining, worst: dict[str, int | None]) -> dict[str, tuple[int, int]]:
        """``{lang: (from class, to class)}`` to expand now; empty when every language is settled.

        ``worst`` is the score to beat; None if a language has too few phrases yet.
        """
        self.share = self.share * how.growth if self.share else how.first_share
        slab = {}
        for lang, classes in self.classes.items():
            start = at = self.done.get(lang, 0)
            taken = 0
            while at < len(classes):
                limit = worst.get(lang)
                if limit is not None and 1000 * self.total[lang] // classes[at][1] < limit:
                    break  # nothing from here on can reach the score, ties included
                if at > start and taken >= self.share * self.total[lang]:
                    break
                taken += classes[at][2]
                at += 1
            if at > start:
                slab[lang] = (classes[start][0], classes[at - 1][0])
                self.done[lang] = at
        return slab


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", how: Mining = Mining()) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``how.top`` phrases of every language.

    Everything is per language; a null one is ``und``. ``n`` counts its words, ``a`` the
    phrase, ``l`` and ``r`` its parts at the weakest cut. Null, empty and blank texts
    have no words; rows count as often as they are repeated, whatever their ids; ties
    are settled by count and then by the bytes of the phrase. A language without a
    frequent phrase has no rows. Other columns are not read.
    """
    spark, limit = docs.sparkSession, how.filter_bits
    for seed in range(SEEDS):
        table = _tokenised(docs, lang_col, text_col, how, seed, work_dir(spark, "phrases"))
        vocabulary = cut_lineage(_vocabulary(table))
        if not _numbers_clash(vocabulary):
            break
    else:
        raise RuntimeError("two words of one number under every seed")
    # one row per language, and CLASSES rows per doubling of the count
    total = {row.lang: row.n for row in vocabulary.groupBy("lang").agg(F.sum("f").alias("n")).collect()}
    totals = spark.createDataFrame(list(total.items()), "lang string, n long")
    words = vocabulary.where(F.col("f") >= how.least).select("lang", "word", F.col("number").alias("w0"), F.col("f").alias("a"))
    words = words.withColumn("class", F.floor(F.log2("a") * CLASSES).cast("int"))
    classes: dict[str, list] = {}
    for row in words.groupBy("lang", "class").agg(F.min("a").alias("least"), F.sum("a").alias("mass")).orderBy("lang", "class").collect():
        classes.setdefault(row.lang, []).append((row["class"], row.least, row.mass))
    frequent = Filter.of(words, ["w0"], limit)

    frontier, worst, best = Frontier(total, classes), {}, None
    while slab := frontier.next_slab(how, worst):
        bounds = F.broadcast(spark.createDataFrame([(lang, *ends) for lang, ends in slab.items()], "lang string, lo int, hi int"))
        start = words.join(bounds, "lang").where("class between lo and hi").select("lang", "w0", "a")
        levels = {1: start}
        beat = F.broadcast(spark.createDataFrame(list(worst.items()), "lang string, beat long"))
        # what ends a phrase bounds its score as its first word does
        promising = words.join(F.broadcast(totals), "lang").join(beat, "lang", "left").where("beat is null or 1000 * n div a >= beat")
        ending = Filter.of(promising, ["w0"], limit) if worst else frequent
        for size in range(2, how.longest + 1):
            levels[size] = cut_lineage(_grown(table, size, levels[size - 1], frequent, ending if size == how.longest else frequent, how))
        left = reduce(DataFrame.union, (_as_phrases(rows, size) for size, rows in levels.items()))
        alone = _as_phrases(words, 1)
        alive = reduce(DataFrame.union, (_as_phrases(_survivors(levels[size], size, how.longest), size) for size in range(2, how.longest + 1)))
        # the last cut needs no counts but the known ones, and no phrase scores more than there
        last = _scored(alive, F.array(F.size("phrase") - 1), left, alone, totals)
        last = cut_lineage(last.join(beat, "lang", "left").where("beat is null or weakest.score >= beat").drop("beat"))
        right = alone.union(_counted_ends(table, last, frequent, how))
        scored = _scored(last.select("lang", "phrase", "a"), F.expr("sequence(1, size(phrase) - 1)"), left, right, totals)
        best = scored if best is None else best.union(scored)
        place = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("weakest.score"), F.desc("a")))
        best = cut_lineage(best.withColumn("place", place).where(F.col("place") <= how.top).drop("place"))
        # one row per language
        found = best.groupBy("lang").agg(F.count(F.lit(1)).alias("found"), F.min("weakest.score").alias("score")).collect()
        worst = {row.lang: row.score for row in found if row.found >= how.top}

    if best is None:
        return spark.createDataFrame([], RESULT)
    spelled = best.select("*", F.posexplode("phrase").alias("pos", "w0")).join(words.select("lang", "w0", "word"), ["lang", "w0"])
    spelled = spelled.groupBy("lang", "phrase").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda p: p["word"].cast("string")), " ").alias("text"),
        *(F.first(c).alias(c) for c in ("a", "n", "weakest")),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("weakest.score"), F.desc("a"), "text"))
    return spelled.withColumn("rank", rank.cast("long")).where(F.col("rank") <= how.top).select(
        "lang", "rank", F.col("text").alias("phrase"), "a", "weakest.l", "weakest.r", "n", "weakest.score"
    )


RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
#: Classes of word counts in each doubling of the count.
CLASSES = 8
#: Attempts at numbering the words without a clash.
SEEDS = 4

PHRASE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), g AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size)
), n AS (
  SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY lang
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), c AS (
  SELECT * FROM f WHERE size >= 2
), kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c b WHERE b.lang = c.lang AND b.a = c.a AND b.size > c.size AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS left_part, array_to_string(w[k + 1:], ' ') AS right_part
  FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM kept)
), s AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, n, ((1000::HUGEINT * cuts.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = left_part JOIN f y ON y.lang = cuts.lang AND y.phrase = right_part
  JOIN n ON n.lang = cuts.lang
), w AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM w
) WHERE rank <= 2000
"""
