import math
import random

import pytest

from logloom.operators import folds

FOLDS = 3


@pytest.fixture(scope="module")
def rows():
    """Rows with labels, folds and weights; some without entries, one term in a single fold."""
    rnd = random.Random(4)
    out = []
    for i in range(60):
        label = float(i % 3 == 0)
        words = [w for w in "abcdefgh" if rnd.random() < (0.7 if (w < "d") == bool(label) else 0.3)]
        out.append((i, label, rnd.randrange(FOLDS), {w: round(rnd.uniform(0.1, 2), 3) for w in words} if i % 11 else {}))
    out[5][3]["only here"] = 1.0
    return out


@pytest.fixture(scope="module")
def tables(spark, rows):
    entries = [(i, t, w, "x") for i, _, _, words in rows for t, w in words.items()]
    labels = [(i, label, fold, 9) for i, label, fold, _ in rows]
    return (
        spark.createDataFrame(entries, "id long, term string, weight double, label string"),
        spark.createDataFrame(labels, "id long, label double, fold int, term int"),
    )


def plain_bayes(rows, alpha):
    """Fold by fold: fit on the other folds, guess the own one."""
    terms = {t for r in rows for t in r[3]}
    result = {}
    for fold in range(FOLDS):
        train, test = [r for r in rows if r[2] != fold], [r for r in rows if r[2] == fold]
        models = {}
        for label in (0.0, 1.0):
            mine = [r for r in train if r[1] == label]
            sums = {t: sum(r[3].get(t, 0) for r in mine) for t in terms}
            mass = sum(sums.values()) + alpha * len(terms)
            models[label] = math.log(len(mine) / len(train)), {t: math.log((sums[t] + alpha) / mass) for t in terms}
        guess = [max((0.0, 1.0), key=lambda c: (models[c][0] + sum(w * models[c][1][t] for t, w in r[3].items()), -c)) for r in test]
        pairs = [(r[1], g) for r, g in zip(test, guess)]
        tp, wrong = pairs.count((1.0, 1.0)), sum(a != b for a, b in pairs)
        result[fold] = len(test), len(test) - wrong, 2 * tp / (2 * tp + wrong) if tp else 0.0
    return result


def test_naive_bayes_folds_equal_separate_fits(tables, rows):
    smoothings = (0.01, 0.5, 1.0, 20.0)
    got = folds.naive_bayes_folds(*tables, smoothings, FOLDS).collect()
    assert len(got) == len(smoothings) * FOLDS
    for r in got:
        n, right, f1 = plain_bayes(rows, r.smoothing)[r.fold]
        assert (r.n, r.right) == (n, right) and r.f1 == pytest.approx(f1) and r.accuracy == pytest.approx(right / n)
    board = {r.smoothing: r for r in folds.naive_bayes_board(*tables, smoothings, FOLDS).collect()}
    for a in smoothings:
        f1 = [v[2] for v in plain_bayes(rows, a).values()]
        mean = sum(f1) / FOLDS
        assert board[a].mean == pytest.approx(mean) and board[a].std == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in f1) / FOLDS))


def test_naive_bayes_of_nothing(tables):
    entries, labels = tables
    assert folds.naive_bayes_folds(entries.limit(0), labels.limit(0), (1.0,), FOLDS).count() == 0
    # without any weights the larger class of the other folds wins everywhere
    assert {r.f1 for r in folds.naive_bayes_folds(entries.limit(0), labels, (1.0,), FOLDS).collect()} == {0.0}


def test_f_scores(tables, rows):
    got = {r.term: r.f_score for r in folds.f_scores(*tables).collect()}
    assert set(got) == {t for r in rows for t in r[3]}
    for term, score in got.items():
        groups = [[r[3].get(term, 0.0) for r in rows if r[1] == c] for c in (0.0, 1.0)]
        n = sum(map(len, groups))
        mean = sum(map(sum, groups)) / n
        between = sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups)
        within = sum(sum((x - sum(g) / len(g)) ** 2 for x in g) for g in groups)
        assert score == pytest.approx(between / (within / (n - 2)))
    best = folds.select_terms(*tables, 3).orderBy("rank").collect()
    assert [r.term for r in best] == sorted(got, key=lambda t: (-round(got[t], 6), t))[:3]


def test_f_scores_of_constant_terms(spark):
    entries = spark.createDataFrame([(1, "both", 1.0), (2, "both", 1.0), (3, "both", 1.0), (4, "both", 1.0), (1, "one", 2.0), (2, "one", 2.0)], "id long, term string, weight double")
    rows = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 0.0), (4, 0.0)], "id long, label double")
    assert {tuple(r) for r in folds.f_scores(entries, rows).collect()} == {("both", 0.0), ("one", math.inf)}
    assert folds.f_scores(entries, rows.where("label = 1")).count() == 0
