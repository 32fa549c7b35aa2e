"""Word counts, vocabularies, token pipelines and integer sequences."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions.arrays import pad_front
from logloom.functions.text import basic_tokens, excluded_tokens, final_tokens, java_split
from logloom.plans.rows import elements, numbered_elements
from logloom.plans.segments import number_rows
from logloom.plans.skew import hot_keys, salted_join
from logloom.session import cut_lineage


def words_of(df: DataFrame, text: str = "value") -> DataFrame:
    return elements(df, [], java_split(F.col(text)), "word")


def word_count(df: DataFrame, text: str = "value") -> DataFrame:
    """(word, count) under the Java split rule; combined before the shuffle."""
    return words_of(df, text).groupBy("word").count()


def distinct_elements(df: DataFrame, array: str, approx: bool = False) -> DataFrame:
    """Number of distinct elements over a whole array column."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return elements(df, [], array, "element").agg(count("element").alias("n_distinct"))


def term_frequencies(df: DataFrame, tokens: str) -> DataFrame:
    """(term, df, cf): documents holding the term, and occurrences, in one pass.

    Each row emits its distinct terms once for ``df`` and all its tokens for
    ``cf``; only per-term sums are shuffled, never (document, term) pairs.
    """
    seen = F.transform(
        F.array_distinct(tokens), lambda t: F.struct(t.alias("t"), F.lit(1).alias("d"))
    )
    used = F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(0).alias("d")))
    marks = elements(df, [], F.concat(seen, used), "_m")
    return marks.groupBy(F.col("_m.t").alias("term")).agg(
        F.sum(F.col("_m.d").cast("bigint")).alias("df"),
        F.sum((1 - F.col("_m.d")).cast("bigint")).alias("cf"),
    )


#: Entries up to which a dictionary of tokens is broadcast (some 20 MB).
BROADCAST_ENTRIES = 300_000


def replace_tokens(
    df: DataFrame,
    key: str,
    tokens: str,
    dictionary: DataFrame,
    words: bool = False,
    broadcast_entries: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """(key, tokens) with every token found in ``dictionary(token, value)`` replaced.

    ``key`` must identify a row. A dictionary of up to ``broadcast_entries`` is
    broadcast and looked up row by row, so no token moves; beyond that the tokens are
    dealt, frequent ones salted by their count, and rows without a token pass by the join.
    With ``words`` a value of several words becomes several tokens. Of several
    values for a token the smallest counts.
    """
    known = cut_lineage(dictionary.groupBy(F.col("token").alias("_t")).agg(F.min("value").alias("_v")))
    if known.count() <= broadcast_entries:
        out = df.select(key, _looked_up(df.sparkSession, known)(F.coalesce(tokens, F.array())).alias("_w"))
    else:
        rows = df.select(key, F.posexplode_outer(tokens).alias("_p", "_t"))
        filled = rows.where(F.col("_t").isNotNull())
        hot = hot_keys(filled.groupBy("_t").agg(F.count(F.lit(1)).alias("_n")), "_t", "_n")
        empty = rows.where(F.col("_t").isNull()).withColumn("_v", F.lit(None).cast("string"))
        found = salted_join(filled, known, "_t", hot, F.struct(key, "_p"), "left").unionByName(empty)
        found = found.withColumn("_w", F.coalesce("_v", "_t"))
        placed = F.when(F.col("_w").isNotNull(), F.struct("_p", "_w"))
        lists = found.groupBy(key).agg(F.array_sort(F.collect_list(placed)).alias("_a"))
        out = lists.select(key, F.transform("_a", lambda s: s["_w"]).alias("_w"))
    column = F.col("_w")
    if words:
        column = F.flatten(F.transform(column, lambda w: F.split(w, " ", -1)))
    return out.select(key, column.alias(tokens))


def _looked_up(spark: SparkSession, known: DataFrame):
    """A function of token arrays: tokens in ``known(_t, _v)`` replaced, null tokens left out."""
    shared = spark.sparkContext.broadcast({r._t: r._v for r in known.where("_t is not null and _v is not null").collect()})

    @F.pandas_udf("array<string>")
    def replaced(rows: pd.Series) -> pd.Series:
        value = shared.value.get
        return pd.Series([[value(t, t) for t in tokens if t is not None] for tokens in rows], dtype=object)

    return replaced


def lemmatize(df: DataFrame, key: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    return replace_tokens(df, key, tokens, lemmas)


def expand_contractions(df: DataFrame, key: str, tokens: str, expansions: DataFrame) -> DataFrame:
    return replace_tokens(df, key, tokens, expansions, words=True)


def tokenize(
    df: DataFrame,
    key: str,
    text: str,
    lemmas: DataFrame | None = None,
    excluded: Iterable[str] | None = None,
) -> DataFrame:
    """(key, tokens) by the full pipeline.

    E-mail addresses, stop words, URLs and repeated characters first, then
    lemmas when a dictionary is given, then lower case and a second pass over
    stop words, dots and blanks. Without lemmas nothing is shuffled.
    """
    skip = list(excluded) if excluded is not None else excluded_tokens()
    basic = df.select(key, basic_tokens(F.col(text), skip).alias("tokens"))
    if lemmas is not None:
        basic = lemmatize(basic, key, "tokens", lemmas)
    return basic.select(key, final_tokens(F.col("tokens"), skip).alias("tokens"))


#: More than the places of one array.
USES = 1 << 31


def _use_number(doc: Column, place: Column) -> Column:
    """One number in the order of (doc, place), nulls first: unlike a struct it is summed up by hash, without a sort."""
    key = F.coalesce(doc.cast("decimal(20,0)"), F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)"))
    return (key * F.lit(USES).cast("decimal(10,0)") + place.cast("decimal(10,0)")).cast("decimal(38,0)")


def fit_vocabulary(df: DataFrame, doc: str, words: str, cap: int | None = None) -> DataFrame:
    """(word, n, idx): words by falling count, then first use; ``idx`` starts at 1.

    With ``cap`` only indices below it are kept, found by a distributed top-n;
    otherwise words are numbered in parallel per count.
    """
    numeric = dict(df.dtypes)[doc] in ("int", "bigint")
    first = _use_number(F.col("_d"), F.col("_p")) if numeric else F.struct("_d", "_p")
    uses = numbered_elements(df, [F.col(doc).alias("_d")], words, "_p", "word")
    counted = uses.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("_first"))
    order = [F.desc("n"), F.asc("_first")]
    if cap is not None:
        kept = counted.orderBy(*order).limit(cap - 1)
        # at most cap - 1 rows: one task is enough to number them
        numbered = kept.withColumn("idx", F.row_number().over(Window.orderBy(*order)))
    else:
        blocks = [-F.col("n")]
        if numeric:
            blocks.append(F.floor(F.col("_first") / (USES * 100_000)))
        # numbering reads the words twice
        numbered = number_rows(cut_lineage(counted), [], blocks, order, "idx")
    return numbered.select("word", "n", F.col("idx").cast("int").alias("idx"))


def encode(
    df: DataFrame,
    doc: str,
    words: str,
    vocabulary: DataFrame,
    length: int,
    cap: int | None = None,
) -> DataFrame:
    """(doc, sequence): word indices below ``cap``, padded or cut at the front.

    Unknown words are skipped; a document without known words is all zeros.
    """
    if cap is not None:
        known = vocabulary.where(F.col("idx") < cap).select("word", "idx")
        # bounded by cap: Spark broadcasts it
        found = df.select(doc, F.posexplode_outer(words).alias("_p", "word")).join(known, "word", "left")
        return _sequences(found, doc, length)
    vocabulary = cut_lineage(vocabulary.select("word", "idx", "n"))
    # the last words decide, unless some of them are unknown
    size = F.size(F.coalesce(words, F.array()))
    skipped = F.greatest(size - length, F.lit(0))
    tails = df.select(doc, skipped.alias("_s"), F.slice(words, skipped + 1, F.lit(length)).alias("_w"))
    uses = tails.select(doc, "_s", F.posexplode_outer("_w").alias("_p", "word")).withColumn("_p", F.col("_s") + F.col("_p"))
    open_row = (F.col("_s") > 0) & F.col("idx").isNull()
    short = cut_lineage(_sequences(_known_words(uses, doc, vocabulary), doc, length, F.bool_or(open_row).alias("_open")))
    done = short.where("not _open").select(doc, "sequence")
    if short.where("_open").isEmpty():
        return done
    rest = df.join(short.where("_open").select(F.col(doc).alias("_d")), F.col(doc).eqNullSafe(F.col("_d")), "left_semi")
    whole = rest.select(doc, F.posexplode_outer(words).alias("_p", "word"))
    return done.unionByName(_sequences(_known_words(whole, doc, vocabulary), doc, length))


def _known_words(uses: DataFrame, doc: str, vocabulary: DataFrame) -> DataFrame:
    hot = hot_keys(vocabulary, "word", "n")
    return salted_join(uses, vocabulary.select("word", "idx"), "word", hot, F.struct(doc, "_p"), "left")


def _sequences(found: DataFrame, doc: str, length: int, *more: Column) -> DataFrame:
    placed = F.when(F.col("idx").isNotNull(), F.struct("_p", "idx"))
    rows = found.groupBy(doc).agg(F.array_sort(F.collect_list(placed)).alias("_a"), *more)
    numbers = F.transform("_a", lambda s: s["idx"])
    return rows.select(doc, pad_front(numbers, length).alias("sequence"), *(F.col("_open") for _ in more))
