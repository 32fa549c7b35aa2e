"""Quality rules: base counts and a hashed n-gram likelihood ratio.

Two multinomials over hashed words and word pairs are counted, one over the trusted
documents and one over the whole corpus. A document's score is the mean logarithm
of their ratio over its n-grams, so length does not matter; every document is held
against the same fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.words import hashes, mixed, window_hashes, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
BUCKETS = 1 << 14
#: Words hashed at once: a long text is counted in slices.
SLICE = 1 << 18


def base_counts(text: str | None, window: int = 8) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    found = words(text)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    repeats = 0
    if len(found) > window:
        starts = window_hashes(hashes(found), window)
        order = np.argsort(starts, kind="stable")
        same = starts[order[1:]] == starts[order[:-1]]
        twice = np.zeros(len(starts), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        # a word counts if any window over it is repeated
        edges = np.zeros(len(found) + 1, np.int64)
        at = np.flatnonzero(twice)
        edges[at] += 1
        edges[at + window] -= 1
        repeats = int((np.cumsum(edges[:-1]) > 0).sum())
    return len(found), chars, symbols, len(lines) - len(set(lines)), repeats


def ngram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """Hash buckets of the words and the word pairs, in slices."""
    found = [w.lower() for w in words(text)]
    for start in range(0, len(found), SLICE):
        hashed = hashes(found[start : start + SLICE + 1])
        single = mixed(hashed[:SLICE])
        yield (single % np.uint64(BUCKETS)).astype(np.int64)
        yield (window_hashes(hashed, 2) % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(bucket, raw, target)``: n-grams of all documents and of those whose id is in ``trusted``.

    Every task adds up its own rows first, so at most ``BUCKETS`` rows per task move.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, good in zip(batch["text"], batch["good"]):
                for found in ngram_buckets(text):
                    part = np.bincount(found, minlength=BUCKETS)
                    totals[0] += part
                    if good:
                        totals[1] += part
        used = np.flatnonzero(totals[0])
        yield pd.DataFrame({"bucket": used, "raw": totals[0][used], "target": totals[1][used]})

    good = trusted.select(F.col(id_col).alias("id")).where("id is not null").distinct().withColumn("good", F.lit(True))
    # hashed by id at every size: the list of trusted ids grows with the corpus
    good = good.hint("shuffle_hash")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    marked = rows.where("id is not null").join(good, "id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    marked = marked.union(rows.where("id is null").select("text", F.lit(False)))
    parts = marked.mapInPandas(count, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Smoothed log ratio per bucket; 0 everywhere without trusted text. ``BUCKETS`` numbers at most."""
    totals = np.zeros((2, BUCKETS))
    for row in counts.collect():
        totals[:, row.bucket] = row.raw, row.target
    if not totals[1].sum():
        return np.zeros(BUCKETS)
    raw, target = ((t + 1) / (t.sum() + BUCKETS) for t in totals)
    return np.log(target / raw)


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = -0.15, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, score and verdict of every row, from its whole text.

    Columns: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept. A null or blank text has no words, fails the base
    rules and scores 0. Rows are judged one by one: repeated rows and null ids give
    a result each, an empty table gives none, other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base = np.array([base_counts(text) for text in batch["text"]], np.int64).reshape(-1, 5)
            scores = []
            for text in batch["text"]:
                total, n = 0.0, 0
                for found in ngram_buckets(text):
                    total, n = total + float(ratios[found].sum()), n + len(found)
                scores.append(total / n if n else 0.0)
            yield pd.DataFrame({"id": batch["id"], **{name: base[:, i] for i, name in enumerate(NAMES)}, "score": scores})

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = rows.mapInPandas(run, f"id {kind}, {', '.join(f'{n} long' for n in NAMES)}, score double")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .withColumnRenamed("id", id_col)
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
