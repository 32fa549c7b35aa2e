import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logloom.functions.text import terms, vocabulary_words, whitespace_tokens
from logloom.operators import features, text
from logloom.plans import segments, skew

DOCS = [
    (1, "the cat sat on the mat"),
    (2, "the dog sat"),
    (3, ""),
    (4, "cats and dogs and cats"),
    (5, "the the the the hot"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "id LONG, text STRING")
    return df.withColumn("tokens", whitespace_tokens(F.col("text"))).cache()


def test_word_count(spark):
    df = spark.createDataFrame([("a  b a",), ("",), ("x  ",), (" ",)], "value STRING")
    got = {r.word: r["count"] for r in text.word_count(df).collect()}
    assert got == {"a": 2, "b": 1, "": 2, "x": 1}


def test_term_frequencies(docs):
    got = {r.term: (r.df, r.cf) for r in text.term_frequencies(docs, "tokens").collect()}
    cf = Counter(w for _, t in DOCS for w in t.split())
    df = Counter(w for _, t in DOCS for w in set(t.split()))
    assert got == {w: (df[w], cf[w]) for w in cf}
    assert text.distinct_elements(docs, "tokens").first().n_distinct == len(cf)


def test_tokenize(spark):
    df = spark.createDataFrame(
        [
            (1, "The CAT saaat at http://x.y mail joe@x.org urllink ... mice ! The"),
            (2, "..."),
        ],
        "id LONG, text STRING",
    )
    got = {r.id: r.tokens for r in text.tokenize(df, "id", "text").collect()}
    assert got == {1: ["cat", "saat", "mail", "mice"], 2: []}
    lemmas = spark.createDataFrame([("mice", "mouse"), ("CAT", "cat")], "token STRING, value STRING")
    got = {r.id: r.tokens for r in text.tokenize(df, "id", "text", lemmas).collect()}
    assert got == {1: ["cat", "saat", "mail", "mouse"], 2: []}


def test_contractions(spark):
    df = spark.createDataFrame([(1, ["i", "can't", "go"])], "id LONG, tokens ARRAY<STRING>")
    table = spark.createDataFrame([("can't", "can not")], "token STRING, value STRING")
    out = text.expand_contractions(df, "id", "tokens", table)
    assert out.first().tokens == ["i", "can", "not", "go"]


def test_vocabulary_and_sequences(docs):
    order = ["the", "cats", "sat", "and", "cat"]  # by count, then first use
    counts = Counter(w for _, t in DOCS for w in t.split())
    first = {}
    for i, t in DOCS:
        for p, w in enumerate(t.split()):
            first.setdefault(w, (i, p))
    want = sorted(counts, key=lambda w: (-counts[w], first[w]))
    full = text.fit_vocabulary(docs, "id", "tokens")
    got = [r.word for r in full.orderBy("idx").collect()]
    assert got == want and set(got[:4]) == {"the", "sat", "cats", "and"} and order[0] == got[0]
    assert [r.idx for r in full.orderBy("idx").collect()] == list(range(1, len(want) + 1))
    capped = text.fit_vocabulary(docs, "id", "tokens", cap=4)
    assert [r.word for r in capped.orderBy("idx").collect()] == want[:3]

    def sequence(t, cap):
        idx = {w: i for i, w in enumerate(want, start=1)}
        found = [idx[w] for w in t.split() if cap is None or idx[w] < cap]
        return ([0] * 4 + found)[-4:] if len(found) < 4 else found[-4:]

    for cap, vocab in ((None, full), (4, full), (4, capped)):
        got = {r.id: r.sequence for r in text.encode(docs, "id", "tokens", vocab, 4, cap).collect()}
        assert got == {i: sequence(t, cap) for i, t in DOCS}


def brute_tfidf(docs, sublinear=False):
    n = len(docs)
    df = Counter(w for _, t in docs for w in set(t.split()))
    out = {}
    for i, t in docs:
        tf = Counter(t.split())
        w = {
            k: (1 + math.log(c) if sublinear else c) * (math.log((1 + n) / (1 + df[k])) + 1)
            for k, c in tf.items()
        }
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.update({(i, k): v / norm for k, v in w.items()})
    return out


@pytest.mark.parametrize("sublinear", [False, True])
def test_tfidf(docs, sublinear):
    rows = features.tfidf(docs, "id", "tokens", sublinear=sublinear).collect()
    got = {(r.id, r.term): r.weight for r in rows}
    want = brute_tfidf(DOCS, sublinear)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_tfidf_limits_and_top(docs):
    kept = {r.term for r in features.tfidf(docs, "id", "tokens", min_df=2, max_df=0.5).collect()}
    assert kept == {"sat"}
    sweep = features.feature_counts(docs, "tokens", [0.2, 0.4, 0.6])
    assert {r.min_df: r.features for r in sweep.collect()} == {0.2: 10, 0.4: 2, 0.6: 1}
    weights = features.tfidf(docs, "id", "tokens")
    top = features.top_terms(weights, "id", 1).collect()
    assert {r.id for r in top} == {1, 2, 4, 5}
    best = features.top_corpus_terms(weights, 2).collect()
    want = brute_tfidf(DOCS)
    assert best[0].weight == pytest.approx(max(want.values()))


def test_label_index(spark):
    df = spark.createDataFrame([(3, "b"), (1, "c"), (2, "a"), (4, "b"), (5, None)], "o LONG, y STRING")
    got = {r.label: r.idx for r in features.label_index(df, "y").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}
    got = {r.label: r.idx for r in features.label_index(df, "y", "o").collect()}
    assert got == {"c": 0, "a": 1, "b": 2}


def test_embeddings(spark, docs):
    rows = [("the", [1.0, 0.0]), ("cat", [0.0, 2.0]), ("unused", [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "word STRING, vec ARRAY<FLOAT>")
    got = {r.id: r.features for r in features.mean_embedding(docs, "id", "tokens", vectors, 2).collect()}
    assert got[1] == pytest.approx([2 / 3, 2 / 3]) and got[2] == [1.0, 0.0]
    assert got[3] == [0.0, 0.0] and got[4] == [0.0, 0.0]
    nulls = features.mean_embedding(docs, "id", "tokens", vectors, 2, missing="null")
    assert {r.id for r in nulls.where("features is null").collect()} == {3, 4}
    filled = {r.id: r.features for r in features.impute_mean(nulls, "features", 2).collect()}
    means = [sum(got[i][d] for i in (1, 2, 5)) / 3 for d in (0, 1)]
    assert filled[3] == pytest.approx(means) and filled[1] == pytest.approx(got[1])
    holes = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [3.0, 4.0])], "id LONG, v ARRAY<DOUBLE>")
    fixed = {r.id: r.v for r in features.impute_mean(holes, "v", 2).collect()}
    assert fixed == {1: [1.0, 4.0], 2: [3.0, 4.0]}
    weighted = features.tfidf_embedding(docs, "id", "tokens", vectors, 2, docs)
    idf = {w: math.log(6 / (1 + d)) + 1 for w, d in (("the", 3), ("cat", 1))}
    got = {r.id: r.features for r in weighted.collect()}
    assert got[1] == pytest.approx([2 * idf["the"] / 3, 2 * idf["cat"] / 3])
    vocab = spark.createDataFrame([("the", 1), ("zzz", 2), ("cat", 3)], "word STRING, idx INT")
    matrix = {r.idx: r.vec for r in features.embedding_matrix(vocab, vectors, 2, cap=3).collect()}
    assert matrix == {1: [1.0, 0.0], 2: [0.0, 0.0]}


def test_split_and_predictions(spark):
    df = spark.range(4000).withColumnRenamed("id", "k")
    a = features.stable_split(df, "k", 0.33)
    b = features.stable_split(df.repartition(7), "k", 0.33)
    ones = {r.k for r in a.where("is_test").collect()}
    assert ones == {r.k for r in b.where("is_test").collect()}
    assert 0.29 < len(ones) / 4000 < 0.37
    probs = spark.createDataFrame([(1, [0.2, 0.8]), (2, [0.9, 0.1]), (3, [0.0, 0.1, 0.9])], "id INT, p ARRAY<DOUBLE>")
    labels = spark.createDataFrame([("no", 0), ("yes", 1)], "label STRING, idx INT")
    got = {r.id: r.pred for r in features.decode_predictions(probs, "p", labels).collect()}
    assert got == {1: "yes", 2: "no", 3: None}


def test_salted_join_equals_join(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1500)).alias("k"),
        "id",
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k5", 3), ("zz", 4)], "k STRING, v INT"
    )
    counts = left.groupBy("k").count()
    hot = skew.hot_keys(counts, "k", "count")
    assert [r.k for r in hot.collect()] == ["hot"]
    for how in ("inner", "left"):
        got = skew.salted_join(left, right, "k", hot, F.col("id"), how)
        want = left.join(right, "k", how)
        assert sorted(map(str, got.select("k", "id", "v").collect())) == sorted(
            map(str, want.select("k", "id", "v").collect())
        )


def test_number_rows_equals_window(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 4).alias("k"),
        ((F.col("id") * 37) % 101).alias("v"),
        "id",
    )
    got = segments.number_rows(df, ["k"], [F.floor(F.col("v") / 10)], [F.asc("v"), F.asc("id")])
    groups = {}
    for r in df.collect():
        groups.setdefault(r.k, []).append((r.v, r.id))
    want = {i: n for g in groups.values() for n, (_, i) in enumerate(sorted(g), start=1)}
    assert {r.id: r.pos for r in got.collect()} == want


def test_terms_on_arrays(docs):
    out = docs.select(terms(F.col("text")).alias("t"), vocabulary_words(F.col("text")).alias("v"))
    assert all(r.t == r.v for r in out.collect())


def test_dealt_dictionary_equals_the_broadcast_one(spark):
    rows = [(i, ["the", "ran", f"w{i}"] * (1 + i % 3)) for i in range(200)] + [(900, []), (901, None), (902, [None, "ran"])]
    df = spark.createDataFrame(rows, "doc INT, tokens ARRAY<STRING>")
    entries = spark.createDataFrame([("the", "THE"), ("ran", "run on"), ("w5", "five"), ("w5", "a five")], "token STRING, value STRING")
    for words in (False, True):
        kept = text.replace_tokens(df, "doc", "tokens", entries, words)
        dealt = text.replace_tokens(df, "doc", "tokens", entries, words, broadcast_entries=0)
        assert sorted(kept.collect()) == sorted(dealt.collect()) and dealt.count() == len(rows)
    found = {r.doc: r.tokens for r in kept.collect()}
    assert found[5][:5] == ["THE", "run", "on", "a", "five"] and found[900] == []


def _operators(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rare_terms_beyond_the_broadcast_ones_have_the_same_weights(docs):
    plain = {(r.id, r.term): r.weight for r in features.tfidf(docs, "id", "tokens").collect()}
    dealt = features.tfidf(docs, "id", "tokens", broadcast_terms=2)
    assert {(r.id, r.term): r.weight for r in dealt.collect()} == pytest.approx(plain)
    # pairs meet their weights where they were counted
    assert "SortMergeJoin" not in _operators(features.tfidf(docs, "id", "tokens"))


def test_broadcast_and_dealt_vectors_have_the_same_means(spark, docs):
    vectors = docs.select(F.explode("tokens").alias("word")).distinct().select("word", F.array(F.length("word").cast("float"), F.lit(1.0).cast("float")).alias("vec"))
    there = features.mean_embedding(docs, "id", "tokens", vectors, 2)
    dealt = features.mean_embedding(docs, "id", "tokens", vectors, 2, broadcast_numbers=0)
    assert sorted(map(str, there.collect())) == sorted(map(str, dealt.collect()))


def test_dictionary_is_looked_up_without_moving_tokens(spark):
    rows = spark.createDataFrame([(1, ["a", None, "b"]), (2, []), (3, None)], "id INT, tokens ARRAY<STRING>")
    table = spark.createDataFrame([("a", "x y"), ("b", None)], "token STRING, value STRING")
    out = text.expand_contractions(rows, "id", "tokens", table)
    assert {r.id: r.tokens for r in out.collect()} == {1: ["x", "y", "b"], 2: [], 3: []}
    assert "Exchange" not in _operators(out)


def test_vocabulary_is_counted_by_hash(spark):
    rows = spark.createDataFrame([(7, ["b", "a"]), (None, ["c"]), (-3, ["d", "e"]), (2**63 - 1, ["f"])], "id LONG, words ARRAY<STRING>")
    found = text.fit_vocabulary(rows, "id", "words")
    assert [r.word for r in found.orderBy("idx").collect()] == ["c", "d", "e", "b", "a", "f"]
    assert "SortAggregate" not in _operators(text.fit_vocabulary(rows, "id", "words", cap=5))


def test_tails_with_unknown_words_are_read_whole(spark):
    rows = spark.createDataFrame([(1, list("aabbxx")), (2, list("xb")), (None, list("xbaxxx")), (3, None), (4, list("xaba")), (4, list("ab"))], "id INT, words ARRAY<STRING>")
    known = spark.createDataFrame([("a", 5, 1), ("b", 4, 2)], "word STRING, n LONG, idx INT")
    found = text.encode(rows, "id", "words", known, 2)
    assert {r.id: list(r.sequence) for r in found.collect()} == {1: [2, 2], 2: [0, 2], None: [2, 1], 3: [0, 0], 4: [2, 1]}


def test_tfidf_tasks_grow_with_the_documents(spark, monkeypatch):
    rows = [(i, ["all", f"w{i % 9}", f"x{i}"]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    plain = {(r.id, r.term): r.weight for r in features.tfidf(df, "id", "tokens").collect()}
    monkeypatch.setattr(features, "DOCUMENTS_PER_TASK", 5)
    weights = features.tfidf(df, "id", "tokens")
    assert weights.rdd.getNumPartitions() == 60
    assert {(r.id, r.term): r.weight for r in weights.collect()} == pytest.approx(plain)


def test_pairs_of_documents_do_not_move_again_once_weighed(spark):
    """Rare and frequent terms are normalised apart, in place; documents without an id count as one."""
    rows = [(1, ["a", "b", 'q"\\ \n', None]), (None, ["a", "c"]), (None, ["a", "c", "d"]), (2, ["b", "e", "f"]), (1, ["g"]), (3, None), (4, [])]
    df = spark.createDataFrame(rows, "id INT, tokens ARRAY<STRING>")
    plain = {(r.id, r.term): r.weight for r in features.tfidf(df, "id", "tokens").collect()}
    assert len(plain) == 10 and plain[1, 'q"\\ \n'] == pytest.approx(plain[1, "g"])
    for length in (True, False):
        want = {(r.id, r.term): r.weight for r in features.tfidf(df, "id", "tokens", norm=length).collect()}
        dealt = features.tfidf(df, "id", "tokens", norm=length, broadcast_terms=2)
        assert {(r.id, r.term): r.weight for r in dealt.collect()} == pytest.approx(want)
        above = dealt._jdf.queryExecution().executedPlan().toString().split("Union")[0]
        assert "Exchange" not in above and "Window" not in above


def test_stored_rows_leave_no_shuffle_files(spark):
    from logloom.session import stored

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = blocks.getAllFiles().size()
    rows = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while blocks.getAllFiles().size() > before and time.time() < until:
        time.sleep(0.2)
    assert rows.count() == 7 and time.time() < until
