"""Cross-validation and feature scores as aggregations over (row, term, weight) tables.

A multinomial naive Bayes model is a table of sums. Sums per (fold, class, term) are
taken once; what the other folds hold is the total less the own fold, so every fold
has its training counts by subtraction and every smoothing is scored in the same
pass over the entries. Folds, classes and smoothings are few; only their totals pass
through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.aggregates import top_per_group
from logloom.plans.skew import hot_keys, salted_join
from logloom.session import cut_lineage

#: Scores closer than this many digits are equal; the smaller label wins.
DIGITS = 9


def _at(values: Sequence[float], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), place + 1)


def _per_cell(rows: DataFrame, value: Column, folds: int, classes: Sequence[float]) -> list[list[float]]:
    """``value`` per fold and class, a table of folds x classes numbers."""
    found = {(r.fold, r.label): r.v for r in rows.groupBy("fold", "label").agg(value.alias("v")).collect()}
    return [[float(found.get((f, c)) or 0) for c in classes] for f in range(folds)]


def _without(cells: list[list[float]]) -> list[list[float]]:
    """Per fold and class: the sum over all other folds."""
    return [[sum(row[c] for g, row in enumerate(cells) if g != f) for c in range(len(cells[0]))] for f in range(len(cells))]


def naive_bayes_scores(entries: DataFrame, rows: DataFrame, smoothings: Sequence[float], folds: int) -> tuple[DataFrame, list[float]]:
    """``(id, fold, label, scores)`` of every row and the classes.

    ``entries(id, term, weight)`` has non-negative weights, ``rows(id, label, fold)`` one
    row per id. ``scores`` lists, smoothing by smoothing, the log score of each class
    under the model of the other folds; the vocabulary is all terms of ``entries``.
    Classes are those of ``rows``; a class that the other folds lack never wins.
    Rows without entries are scored by the class shares alone.
    """
    rows = rows.select("id", F.col("label").cast("double").alias("label"), "fold")
    classes = [r.label for r in rows.select("label").distinct().orderBy("label").collect()]
    if not classes:
        return rows.withColumn("scores", F.array().cast("array<double>")), []
    tagged = cut_lineage(entries.select("id", "term", "weight").join(rows, "id"))
    documents = _without(_per_cell(rows, F.count(F.lit(1)), folds, classes))
    mass = _without(_per_cell(tagged, F.sum("weight"), folds, classes))

    cells = [
        F.sum(F.when((F.col("fold") == f) & (F.col("label") == label), F.col("weight")).otherwise(0.0)).alias(f"w{f}_{c}")
        for f in range(folds)
        for c, label in enumerate(classes)
    ]
    counts = cut_lineage(tagged.groupBy("term").agg(F.count(F.lit(1)).alias("uses"), *cells))
    width = counts.count()

    def weight_of(f: int, c: int, a: float) -> Column:
        others = sum((F.col(f"w{g}_{c}") for g in range(folds) if g != f), F.lit(0.0))
        return F.log(others + a) - log(mass[f][c] + a * width) if width else F.lit(0.0)

    models = F.array(*[F.array(*[weight_of(f, c, a) for a in smoothings for c in range(len(classes))]) for f in range(folds)])
    hot = hot_keys(counts, "term", "uses")
    met = salted_join(tagged.select("id", "fold", "term", "weight"), counts.select("term", models.alias("models")), "term", hot, F.col("id"))
    own = met.select("id", "weight", F.element_at("models", F.col("fold") + 1).alias("model"))
    size = len(smoothings) * len(classes)
    sums = own.groupBy("id").agg(F.array(*[F.sum(F.col("weight") * F.col("model")[i]) for i in range(size)]).alias("sums"))

    shares = [[log(n / sum(row)) if n else float("-inf") for n in row] for row in documents]
    prior = [_at([row[c] for row in shares], F.col("fold")) for c in range(len(classes))]
    scores = F.array(*[F.round(F.coalesce(F.col("sums")[i], F.lit(0.0)), DIGITS) + prior[i % len(classes)] for i in range(size)])
    return rows.join(sums, "id", "left").select("id", "fold", "label", scores.alias("scores")), classes


def naive_bayes_folds(entries: DataFrame, rows: DataFrame, smoothings: Sequence[float], folds: int, positive: float = 1.0) -> DataFrame:
    """``(smoothing, fold, n, right, f1, accuracy)``: every smoothing on every fold that has rows.

    ``f1`` is that of the label ``positive``, 0 where nothing is found.
    """
    scored, classes = naive_bayes_scores(entries, rows, smoothings, folds)
    if not classes:
        empty = "smoothing DOUBLE, fold INT, n LONG, right LONG, f1 DOUBLE, accuracy DOUBLE"
        return rows.sparkSession.createDataFrame([], empty)
    found = []
    for at, smoothing in enumerate(smoothings):
        own = F.slice("scores", at * len(classes) + 1, len(classes))
        # the first of the best: the smaller label
        guess = _at(classes, F.array_position(own, F.array_max(own)).cast("int") - 1)
        found.append(F.struct(F.lit(float(smoothing)).alias("smoothing"), guess.alias("guess")))
    guesses = scored.select("fold", "label", F.explode(F.array(*found)).alias("g")).select("fold", "label", "g.*")
    yes, said = F.col("label") == positive, F.col("guess") == positive
    counted = guesses.groupBy("smoothing", "fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") == F.col("guess")).alias("right"),
        F.count_if(yes & said).alias("_hit"),
        F.count_if(yes != said).alias("_miss"),
    )
    f1 = F.when(F.col("_hit") > 0, 2 * F.col("_hit") / (2 * F.col("_hit") + F.col("_miss"))).otherwise(0.0)
    return counted.select("smoothing", "fold", "n", "right", f1.alias("f1"), (F.col("right") / F.col("n")).alias("accuracy"))


def naive_bayes_board(entries: DataFrame, rows: DataFrame, smoothings: Sequence[float], folds: int, positive: float = 1.0) -> DataFrame:
    """``(smoothing, mean, std, accuracy)`` over the folds: F1's mean and population deviation, mean accuracy."""
    per_fold = naive_bayes_folds(entries, rows, smoothings, folds, positive)
    return per_fold.groupBy("smoothing").agg(
        F.avg("f1").alias("mean"), F.stddev_pop("f1").alias("std"), F.avg("accuracy").alias("accuracy")
    )


def f_scores(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """``(term, f_score)``: one-way analysis of variance of each term's weight over the classes.

    One pass: sums and squares per (term, class); rows without the term weigh 0. A
    term that is constant within all classes scores infinity, one that is constant
    altogether 0. Needs two classes and more rows than classes, else there are no rows.
    """
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label").collect()}
    n, k = sum(sizes.values()), len(sizes)
    if k < 2 or n <= k:
        return rows.sparkSession.createDataFrame([], "term STRING, f_score DOUBLE")
    tagged = entries.select("id", "term", "weight").join(rows.select("id", "label"), "id")
    sums = [F.sum(F.when(F.col("label") == label, F.col("weight")).otherwise(0.0)).alias(f"s{c}") for c, label in enumerate(sizes)]
    per_term = tagged.groupBy("term").agg(F.sum(F.col("weight") * F.col("weight")).alias("q"), *sums)
    within_parts = sum((F.pow(f"s{c}", 2) / size for c, size in enumerate(sizes.values())), F.lit(0.0))
    total = sum((F.col(f"s{c}") for c in range(k)), F.lit(0.0))
    between, within = within_parts - F.pow(total, 2) / n, F.col("q") - within_parts
    score = F.when(within > 1e-12 * F.col("q"), (between / (k - 1)) / (within / (n - k)))
    constant = F.when(between > 1e-12 * F.col("q"), F.lit(float("inf"))).otherwise(0.0)
    return per_term.select("term", F.coalesce(score, constant).alias("f_score"))


def select_terms(entries: DataFrame, rows: DataFrame, keep: int, digits: int = 6) -> DataFrame:
    """``(term, f_score, rank)`` of the ``keep`` terms that tell the classes apart best; ties go to the first by name."""
    scored = f_scores(entries, rows).withColumn("f_score", F.round("f_score", digits)).withColumn("_all", F.lit(0))
    return top_per_group(scored, ["_all"], [F.desc("f_score"), F.asc("term")], keep).drop("_all")
