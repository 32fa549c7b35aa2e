"""TF-IDF, label indices, document vectors and repeatable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.arrays import argmax, zeros
from logloom.operators.aggregates import top_per_group, top_rows
from logloom.plans.rows import elements
from logloom.plans.segments import number_rows
from logloom.plans.skew import hot_keys, salted_join
from logloom.session import cut_lineage, stored

#: Terms whose weights are broadcast (some 20 MB), the most frequent first.
BROADCAST_TERMS = 200_000
#: Numbers in a table of word vectors that is broadcast.
BROADCAST_NUMBERS = 4_000_000
#: Documents whose (doc, term) pairs are counted and weighed by one task.
DOCUMENTS_PER_TASK = 2048


def term_counts(df: DataFrame, doc: str, tokens: str) -> DataFrame:
    """(doc, term, tf)."""
    uses = elements(df, [doc], tokens, "term")
    return uses.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(df: DataFrame, tokens: str) -> DataFrame:
    """(term, df)."""
    terms = elements(df, [], F.array_distinct(tokens), "term")
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def row_total(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def _limit(value: float | int, n: Column) -> Column:
    # an integer is a count, a float a share of the documents
    return F.lit(value) if isinstance(value, int) else F.lit(value) * n


def smooth_idf(n: Column, df: Column) -> Column:
    return F.log((F.lit(1) + n) / (F.lit(1) + df)) + 1


def frequencies_of(counts: DataFrame) -> DataFrame:
    """(term, df) of a (doc, term, tf) table.

    Testing ``tf`` keeps this side's columns equal to those of the table itself,
    so that a plan that needs both shuffles the (doc, term) pairs once.
    """
    return counts.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def _weighted_terms(
    freqs: DataFrame, n: Column, min_df: float | int, max_df: float | int
) -> DataFrame:
    freqs = freqs.withColumn("_n", n)
    kept = freqs.where(
        (F.col("df") >= _limit(min_df, F.col("_n"))) & (F.col("df") <= _limit(max_df, F.col("_n")))
    )
    return kept.select("term", "df", smooth_idf(F.col("_n"), F.col("df")).alias("idf"))


def idf_table(
    df: DataFrame, tokens: str, min_df: float | int = 1, max_df: float | int = 1.0
) -> DataFrame:
    """(term, df, idf) of the terms within the document-frequency limits."""
    return _weighted_terms(document_frequencies(df, tokens), row_total(df), min_df, max_df)


def _rare_df(freqs: DataFrame, limit: int) -> int | None:
    """The ``df`` up to which terms are rare, so that about ``limit`` others are left; None if all are few.

    A term that is not among the ``limit`` most frequent has less than that share of
    the pairs, so no task gets a large group.
    """
    terms = freqs.count()
    return None if terms <= limit else freqs.agg(F.percentile_approx("df", 1 - limit / terms).alias("df")).first().df


def _over_length(weighted: DataFrame, others: DataFrame | None = None) -> DataFrame:
    # lengths are summed where the pairs of a document lie; ``others`` has its pairs in the same partition
    squares = F.sum(F.col("weight") * F.col("weight"))
    length = squares.over(Window.partitionBy("_d"))
    if others is not None:
        sums = others.groupBy("_d").agg(squares.alias("_more"))
        weighted = weighted.withColumn("_own", length).join(sums, "_d", "left")
        length = F.col("_own") + F.coalesce("_more", F.lit(0.0))
    return weighted.select("_d", "term", (F.col("weight") / F.sqrt(length)).alias("weight"))


def tfidf(
    df: DataFrame,
    doc: str,
    tokens: str,
    min_df: float | int = 1,
    max_df: float | int = 1.0,
    sublinear: bool = False,
    norm: bool = True,
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """(doc, term, weight), L2-normalised per document unless ``norm`` is off."""
    # tokens are dealt by document, as one string each: pairs are counted, weighed and normalised where they
    # are, in as many tasks as there are documents for, whatever the session's number of partitions
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.select(doc).count() // DOCUMENTS_PER_TASK))
    kind = df.schema[tokens].dataType
    # a struct, as joins on it find documents without an id, too
    packed = df.select(F.struct(F.col(doc).alias("doc")).alias("_d"), F.to_json(tokens).alias("_t"))
    dealt = packed.repartition(tasks, "_d").select("_d", F.from_json("_t", kind).alias("_t"))
    counts = term_counts(dealt, "_d", "_t")
    freqs = stored(frequencies_of(counts))
    idf = _weighted_terms(freqs, row_total(df), min_df, max_df)
    tf = 1 + F.log("tf") if sublinear else F.col("tf")

    def weighed(pairs: DataFrame) -> DataFrame:
        return pairs.select("_d", "term", (tf * F.col("idf")).alias("weight"))

    rare = _rare_df(freqs, broadcast_terms)
    if rare is None:
        common = weighed(counts.join(F.broadcast(idf), "term"))
        weights = _over_length(common) if norm else common
    else:
        # pairs of frequent terms stay where they are, those of the others move to their weights and back
        common = weighed(counts.join(F.broadcast(idf.where(F.col("df") > rare)), "term"))
        others = counts.join(F.broadcast(freqs.where(F.col("df") > rare).select("term")), "term", "left_anti")
        others = weighed(others.join(idf.where(F.col("df") <= rare), "term"))
        if norm:
            others = others.repartition(tasks, "_d")
            common, others = _over_length(common, others), _over_length(others, common)
        weights = common.unionByName(others)
    return weights.select(F.col("_d.doc").alias(doc), "term", "weight")


def feature_counts(df: DataFrame, tokens: str, shares: Sequence[float]) -> DataFrame:
    """(min_df, features): terms left at each threshold, from one frequency table."""
    freqs = document_frequencies(df, tokens).withColumn("_n", row_total(df))
    hits = [
        F.struct(
            F.lit(float(s)).alias("min_df"),
            F.count_if(F.col("df") >= F.lit(float(s)) * F.col("_n")).alias("features"),
        )
        for s in shares
    ]
    return freqs.agg(F.array(*hits).alias("_h")).select(F.inline("_h"))


def top_terms(weights: DataFrame, doc: str, n: int) -> DataFrame:
    """The ``n`` heaviest terms of every document."""
    return top_per_group(weights, [doc], [F.desc("weight"), F.asc("term")], n)


def top_corpus_terms(weights: DataFrame, n: int) -> DataFrame:
    """The ``n`` terms with the largest weight anywhere in the corpus."""
    best = weights.groupBy("term").agg(F.max("weight").alias("weight"))
    return top_rows(best, [F.desc("weight"), F.asc("term")], n)


def label_index(df: DataFrame, label: str, first_seen: str | None = None) -> DataFrame:
    """(label, idx) from 0: alphabetical, or by first use in ``first_seen`` order."""
    named = df.where(F.col(label).isNotNull())
    if first_seen is None:
        labels = named.select(F.col(label).cast("string").alias("label")).distinct()
        bucket, order = F.substring("label", 1, 3), [F.asc("label")]
    else:
        labels = named.groupBy(F.col(label).cast("string").alias("label")).agg(
            F.min(first_seen).alias("_first")
        )
        bucket, order = F.floor(F.col("_first") / 100_000), [F.asc("_first"), F.asc("label")]
    # numbering reads the labels twice
    numbered = number_rows(cut_lineage(labels), [], [bucket], order, "_pos")
    return numbered.select("label", (F.col("_pos") - 1).cast("int").alias("idx"))


# --- word vectors --------------------------------------------------------


def _vector_sums(df: DataFrame, doc: str, tokens: str, vectors: DataFrame, dim: int, numbers: int) -> DataFrame:
    # vectors: (term, vec, w). One fixed-width sum per dimension, so the map side
    # combines and no (document, dimension) rows exist. A table that can be broadcast
    # meets the tokens where they are: only one row per document and task moves.
    vectors = cut_lineage(vectors)
    if vectors.count() * dim <= numbers:
        joined = elements(df, [doc], tokens, "term").join(F.broadcast(vectors), "term").withColumn("tf", F.lit(1))
    else:
        counts = term_counts(df, doc, tokens)
        hot = hot_keys(frequencies_of(counts), "term", "df")
        joined = salted_join(counts, vectors, "term", hot, F.col(doc))
    share = F.col("tf") * F.col("w")
    sums = [
        F.sum(share * F.get("vec", F.lit(i)).cast("double")).alias(f"_s{i}") for i in range(dim)
    ]
    summed = joined.groupBy(doc).agg(F.sum("tf").alias("_n"), *sums)
    mean = F.array(*[F.col(f"_s{i}") / F.col("_n") for i in range(dim)])
    return summed.select(doc, mean.alias("features"))


def mean_embedding(
    df: DataFrame,
    doc: str,
    tokens: str,
    vectors: DataFrame,
    dim: int,
    missing: str = "zero",
    weights: DataFrame | None = None,
    broadcast_numbers: int = BROADCAST_NUMBERS,
) -> DataFrame:
    """(doc, features): the mean of the vectors of a document's known words.

    Every occurrence counts. ``weights(term, w)`` scales each vector (terms it
    lacks take its largest weight). A document without known words gets the
    zero vector, or null with ``missing="null"``.
    """
    known = vectors.select(F.col("word").alias("term"), "vec")
    if weights is None:
        known = known.withColumn("w", F.lit(1.0))
    else:
        largest = weights.agg(F.max("w").alias("m")).scalar()
        known = known.join(weights.select("term", "w"), "term", "left").withColumn(
            "w", F.coalesce("w", largest)
        )
    means = _vector_sums(df, doc, tokens, known, dim, broadcast_numbers)
    out = df.select(doc).join(means, doc, "left")
    if missing == "null":
        return out
    return out.withColumn("features", F.coalesce("features", zeros(dim)))


def tfidf_embedding(
    df: DataFrame, doc: str, tokens: str, vectors: DataFrame, dim: int, corpus: DataFrame
) -> DataFrame:
    """Mean of idf-weighted word vectors; idf is fitted on ``corpus``."""
    weights = idf_table(corpus, tokens).select("term", F.col("idf").alias("w"))
    return mean_embedding(df, doc, tokens, vectors, dim, weights=weights)


def impute_mean(df: DataFrame, column: str, dim: int) -> DataFrame:
    """Fill missing vectors, and NaN or null entries, with the column means."""

    def entry(i: int) -> Column:
        x = F.get(column, F.lit(i)).cast("double")
        return F.when(~F.isnan(x), x)

    means = df.agg(F.array(*[F.avg(entry(i)) for i in range(dim)]).alias("m")).scalar()
    known = F.coalesce(F.col(column).cast("array<double>"), F.array_repeat(F.lit(None), dim))
    filled = F.transform(
        F.arrays_zip(known.alias("x"), F.col("_means").alias("m")),
        lambda p: F.coalesce(F.when(~F.isnan(p["x"]), p["x"]), p["m"]),
    )
    return df.withColumn("_means", means).withColumn(column, filled).drop("_means")


def embedding_matrix(
    vocabulary: DataFrame, vectors: DataFrame, dim: int, cap: int | None = None
) -> DataFrame:
    """(idx, word, vec) for indices below ``cap``; unknown words get zeros."""
    kept = vocabulary if cap is None else vocabulary.where(F.col("idx") < cap)
    joined = kept.select("idx", "word").join(vectors.select("word", "vec"), "word", "left")
    blank = zeros(dim).cast("array<float>")
    return joined.select("idx", "word", F.coalesce("vec", blank).alias("vec"))


# --- splits and predictions ----------------------------------------------


def split_bucket(key: Column, seed: int, buckets: int = 10_000) -> Column:
    """A bucket that depends on key and seed only, never on partitioning."""
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def stable_split(df: DataFrame, key: str, test_share: float, seed: int = 42) -> DataFrame:
    """Add ``is_test``; the same row always lands on the same side."""
    test = split_bucket(F.col(key), seed) < int(round(test_share * 10_000))
    return df.withColumn("is_test", test)


def decode_predictions(df: DataFrame, probs: str, labels: DataFrame) -> DataFrame:
    """Add ``pred``, the label of the most probable index; null when unmapped."""
    mapping = labels.select(F.col("label").alias("pred"), F.col("idx").alias("_i"))
    return df.withColumn("_i", argmax(F.col(probs))).join(mapping, "_i", "left").drop("_i")
