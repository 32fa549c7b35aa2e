"""Language, toxicity, quality, scoring and encoding against plain versions and edge rows."""

import base64
import gc
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from logloom.llm import byte_bpe, language, lm_score, mixing, quality, toxicity
from logloom.llm.words import lower_words, words

EDGES = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "the cat"), (5, "12 34 !?"), (6, "the " * 30_000), (7, "the cat"), (7, "the cat"), (8, " x  \x1c É")]


def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows and clashing extra columns."""
    rows = [(i, t, "en", "s", 0, 9) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, bucket int, id int")


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def test_words_are_runs_of_non_blanks():
    assert words("a b \x1cc\x0bd") == ["a b".encode(), b"\x1cc", b"d"]
    assert lower_words("ÀB") == ["Àb".encode()] and words(None) == []


# --- language ---


def test_automaton_equals_substring_search():
    rnd = random.Random(4)
    for _ in range(150):
        texts = [language.marked("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 8)))) for _ in range(rnd.randint(1, 6))]
        automaton = language.SuffixAutomaton(texts)
        for _ in range(15):
            word = "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 9)))
            at = count = 0
            while at < len(word):
                end = at
                while end < len(word) and any(word[at : end + 1] in t for t in texts):
                    end += 1
                at, count = max(end, at + 1), count + 1
            assert automaton.phrases(word) == count


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    rows = found.collect()
    assert len(rows) > 200 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    model = language.LanguageModel({"en": ["the cat and the dog"], "de": ["der hund und die katze"]}, 100)
    rows = language.identify(edge_docs(spark), model).collect()
    assert len(rows) == len(EDGES)
    by_id = {r.doc_id: r.lang_pred for r in rows}
    assert [by_id[i] for i in (1, 2, 3, 5)] == ["und"] * 4 and by_id[7] == by_id[6] == by_id[None] == "en"
    assert language.identify(empty_docs(spark), model).count() == 0
    assert language.fit(empty_docs(spark)).langs == []
    assert {r.lang_pred for r in language.identify(edge_docs(spark), language.fit(empty_docs(spark))).collect()} == {"und"}
    kept = language.label(edge_docs(spark), model)
    assert kept.columns == edge_docs(spark).columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 6, 7, 7, 8]


def test_label_asks_once(spark):
    model = language.LanguageModel({"en": ["the cat and the dog"], "de": ["der hund und die katze"]}, 100)
    kept = language.label(edge_docs(spark).withColumn("lang", F.lit(None).cast("string")), model)
    # the optimizer once copied the answer into the filter: two workers per task, each text parsed twice
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r.doc_id or 0, r.lang) for r in kept.collect()) == [(0, "en"), (6, "en"), (7, "en"), (7, "en"), (8, "en")]


# --- toxicity ---


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels, rows_per_label=400, epochs=4)
    rows = toxicity.classify(docs, model).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.05 * len(rows)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    edges = toxicity.classify(edge_docs(spark), model).collect()
    assert len(edges) == len(EDGES) and len({r.score for r in edges if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.classify(empty_docs(spark), model).count() == 0


def test_toxicity_slices_equal_whole(monkeypatch):
    shape = toxicity.Shape(word_buckets=64, start_buckets=16)
    rng = np.random.default_rng(0)
    taps = {w: rng.normal(size=(w, shape.dim, shape.filters)) for w in shape.widths}
    model = toxicity.ToxicModel(
        shape, rng.normal(size=(81, shape.dim)), taps, np.zeros(shape.total), rng.normal(size=shape.total), 0.1,
        ["a", "b"], rng.normal(size=(81, 2)), np.array([0.0, 1.0]),
    )
    texts = [" ".join(f"w{i * j % 37}" for i in range(n)) for j, n in enumerate((0, 1, 2, 7, 8, 9, 50), 1)]
    whole = [toxicity.Scorer(model).score(t) for t in texts]
    monkeypatch.setattr(toxicity, "SLICE", 4)
    assert np.allclose(whole, [toxicity.Scorer(model).score(t) for t in texts], atol=1e-5)


def test_toxicity_thresholds_come_from_all_labelled_rows(spark, monkeypatch):
    """All labelled rows that are neither held out nor trained on set the thresholds, however few are taken to train."""
    counted, plain = [], toxicity._judged
    monkeypatch.setattr(toxicity, "_judged", lambda rows, model: counted.append(plain(rows, model)) or counted[-1])
    texts = [(i, f"word{i % 7} " + ("bad awful" if i % 3 == 0 else "good fine"), "en") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, rows_per_label=25, epochs=2)
    learned = labels.where(~language.held_out("doc_id")).count()
    assert counted[0][["clean", "toxic"]].to_numpy().sum() == learned - 40
    assert len(model.shifts) == 1


def test_toxicity_scores_for_thresholds_where_the_texts_lie(spark, monkeypatch):
    plans, plain = [], toxicity._judged

    def judged(rows, model):
        counts = toxicity._counted(*rows, model)
        plans.append(counts._jdf.queryExecution().optimizedPlan().toString())
        return plain(rows, model)

    monkeypatch.setattr(toxicity, "_judged", judged)
    docs = spark.createDataFrame([(i, f"{'vile' if i % 3 == 0 else 'kind'} word{i % 7}", "en") for i in range(300)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, rows_per_label=25, epochs=1)
    # the join with the labels is above the scoring: it sees no text
    plan = plans[0]
    assert plan.index("Join Inner") < plan.index("MapInPandas")


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([(7, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(edge_docs(spark), labels) is None
    assert {r.score for r in toxicity.classify(edge_docs(spark), None).collect()} == {0.0}


# --- quality ---


def plain_counts(text):
    found = words(text)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = {i + k for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    chars = sum(len(w.decode()) for w in found)
    return len(found), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("seed", range(30))
def test_base_counts(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(["a ", "b ", "é# ", "\n", "x y\n", " ", " ", "\t|"]) for _ in range(rnd.randint(0, 120)))
    assert quality.base_counts(text) == plain_counts(text)


def test_quality_ratio_and_verdict(spark):
    good = [(i, " ".join(f"good{random.Random(100 * i + k).randint(0, 50)}" for k in range(60)), "en") for i in range(1, 40)]
    bad = [(i, " ".join(f"junk{random.Random(100 * i + k).randint(0, 50)}###" for k in range(60)), "en") for i in range(40, 60)]
    docs = spark.createDataFrame(good + bad + [(None, "x " * 30, "en"), (99, None, "en")], "doc_id long, text string, good string")
    trusted = docs.where("doc_id < 30").select("doc_id")
    counts = quality.bucket_counts(docs, trusted)
    total = counts.agg(F.sum("raw"), F.sum("target")).first()
    want = [sum(2 * len(words(t)) - 1 for i, t, _ in docs.collect() if t and keep(i)) for keep in (lambda i: True, lambda i: i is not None and i < 30)]
    assert list(total) == want
    rows = {r.doc_id: r for r in quality.judge(docs, quality.log_ratios(counts)).collect()}
    assert all(rows[i].kept for i in range(1, 30)) and not any(rows[i].kept for i in range(40, 60))
    assert rows[99].base_failed and rows[99].n_words == 0 and rows[99].score == 0
    assert quality.judge(empty_docs(spark), quality.log_ratios(quality.bucket_counts(empty_docs(spark), trusted))).count() == 0


# --- scoring ---


def plain_scores(rows, min_count=2):
    single, followed, pairs, out = Counter(), Counter(), Counter(), {}
    for _, text in rows:
        w = lower_words(text)
        single.update(w), followed.update(w[:-1]), pairs.update(zip(w, w[1:]))
    total = sum(single.values())
    for doc, text in rows:
        w = lower_words(text)
        gain = math.log(single[w[0]] / total) if w else 0.0
        for a, b in zip(w, w[1:]):
            seen = pairs[a, b] >= min_count
            gain += math.log(pairs[a, b] / followed[a]) if seen else math.log(0.4 * single[b] / total)
        n, before = out.get(doc, (0, 0.0))
        out[doc] = n + len(w), before + gain
    return out


@pytest.mark.parametrize("limits", [None, (64, 16, 300, 200)])
def test_lm_scores_equal_plain_counts(spark, monkeypatch, limits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(edge_docs(spark).select("doc_id", "text"))
    if limits:  # small lists, buffers and groups: every path is taken
        for name, value in zip(("HOT_WORDS", "HOT_PAIRS", "BUFFER", "GROUP"), limits):
            monkeypatch.setattr(lm_score, name, value)
    got = {r.doc_id: r for r in lm_score.score(docs).collect()}
    want = plain_scores([tuple(r) for r in docs.collect()])
    assert got.keys() == want.keys()
    for doc, (n, gain) in want.items():
        assert got[doc].n_words == n and got[doc].log_prob == pytest.approx(gain, rel=1e-9)
        assert (got[doc].score is None) == (n == 0)
    assert lm_score.score(empty_docs(spark)).count() == 0


def plain_backoff(rows, order, min_count=2):
    grams, followed, out = Counter(), Counter(), {}
    for _, text in rows:
        w = lower_words(text)
        for n in range(1, order + 1):
            spots = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
            grams.update(spots), followed.update(spots[:-1])
    total = sum(n for gram, n in grams.items() if len(gram) == 1)

    def gain(gram):
        if len(gram) == 1:
            return math.log(grams[gram] / total)
        return math.log(grams[gram] / followed[gram[:-1]]) if grams[gram] >= min_count else math.log(0.4) + gain(gram[1:])

    for doc, text in rows:
        w = lower_words(text)
        n, before = out.get(doc, (0, 0.0))
        out[doc] = n + len(w), before + sum(gain(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w)))
    return out


@pytest.mark.parametrize("order,limits", [(3, None), (3, (64, 16, 300, 200)), (4, (64, 16, 300, 2000)), (2, (64, 16, 300, 200))])
def test_lm_scores_of_longer_contexts(spark, monkeypatch, order, limits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).union(edge_docs(spark).select("doc_id", "text"))
    salad = [(900, "a b c x"), (901, "a b c y"), (902, "d b c z"), (903, "d b c z"), (904, "a b c z"), (905, "q"), (906, "q b")]
    docs = docs.union(spark.createDataFrame(salad, "doc_id long, text string"))
    for name, value in zip(("HOT_WORDS", "HOT_PAIRS", "BUFFER", "GROUP"), limits or ()):
        monkeypatch.setattr(lm_score, name, value)
    got = {r.doc_id: r for r in lm_score.score(docs, order=order).collect()}
    want = plain_backoff([tuple(r) for r in docs.collect()], order)
    assert got.keys() == want.keys()
    for doc, (n, gain) in want.items():
        assert got[doc].n_words == n and got[doc].log_prob == pytest.approx(gain, rel=1e-9)
    assert lm_score.score(empty_docs(spark), order=order).count() == 0


@pytest.mark.parametrize("order,limits", [(3, (64, 16, 300, 40)), (3, (64, 16, 300, 100_000)), (4, (64, 16, 300, 100_000)), (4, (32, 32, 100, 40))])
def test_lm_scores_with_words_beyond_a_group(spark, monkeypatch, order, limits):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(80).collect()]
    rows += [(1000 + i, "the " * i + f"rare{i % 7} the rare{i % 5} x{i} the") for i in range(60)] + [(2000, "x"), (2001, "x the"), (2001, "x the"), (2002, None)]
    for name, value in zip(("HOT_WORDS", "HOT_PAIRS", "BUFFER", "GROUP"), limits):
        monkeypatch.setattr(lm_score, name, value)
    got = {r.doc_id: r for r in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string"), order=order).collect()}
    want = plain_backoff(rows, order)
    assert got.keys() == want.keys()
    for doc, (n, gain) in want.items():
        assert got[doc].n_words == n and got[doc].log_prob == pytest.approx(gain, rel=1e-9)


def test_lm_codes_are_one_per_word():
    rnd = random.Random(5)
    texts = [t for _, t in EDGES] + ["".join(rnd.choice("abAB \t\x0b\x1cé\n\u3000") for _ in range(rnd.randint(0, 400))) for _ in range(60)]
    texts += ["x" * n + " " + "y" * n + " " + "X" * n for n in (63, 64, 65, 128, 5000)] + [f"w{i}" for i in range(3000)]
    codes, lengths = lm_score._codes(texts)
    want = [w for t in texts for w in lower_words(t)]
    assert lengths.tolist() == [len(lower_words(t)) for t in texts] and len(codes) == len(want)
    assert len(set(zip(want, codes.tolist()))) == len(set(want)) == len(set(codes.tolist()))
    assert lm_score._codes([None, "", " \n"])[1].tolist() == [0, 0, 0] and lm_score._codes([])[1].tolist() == []


def test_lm_rows_move_once():
    """Rows back off where they are, unless their last context word has more rows than a group."""
    rnd = random.Random(7)
    texts = [" ".join(f"w{int(rnd.paretovariate(0.7))}" for _ in range(300)) for _ in range(40)]
    codes = lm_score._codes(texts)[0]
    words, n = np.unique(codes, return_counts=True)
    found = lm_score.Frequent(len(codes), words[n > 9], n[n > 9], n[n > 9])
    for order in (2, 3):
        found.set_grams(order, *[np.empty(0, np.int64)] * 3)
    found.share_out(3)
    blocks = list(lm_score._deal(found, 3, np.arange(40), np.full(40, 300), codes))
    assert {b["group"] >> 40 for b in blocks} == {-1, lm_score.WHOLE}
    whole = [b for b in blocks if b["group"] >= 0]
    assert len(whole) == 1 and lm_score._unpack(whole[0]["block"])[4].shape == (3, 40 * 299)
    out = lm_score._join_whole(found, 2, whole[0]["group"], [whole[0]["block"]])
    assert {b["group"] >> 40 for b in out} == {-1, lm_score.SUMS}
    found.hot = 1
    kinds = {b["group"] >> 40 for b in lm_score._deal(found, 3, np.arange(40), np.full(40, 300), codes)}
    assert kinds == {-1, lm_score.WHOLE, 2, 3}


# --- encoding ---


def test_bpe_equals_library(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    with open(path, "rb") as file:
        content = file.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.ByteBPE(ranks, pattern)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))) for letters in ("ab", "aA1 .'s", "é漢🙂 a\n", " \t\n", "0af", "<|endoftext|>") for _ in range(150)]
    for text in [*texts, "a" * 20_000]:
        ids = bpe.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text) and bpe.decode(ids) == text.encode()
    tokenizer = byte_bpe.Tokenizer(spark, path, pattern)
    rows = byte_bpe.digests(tokenizer.encode(edge_docs(spark)), tokenizer).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((i, len(plain.encode_ordinary(t or ""))) for i, t in EDGES)
    assert byte_bpe.digests(tokenizer.encode(empty_docs(spark)), tokenizer).count() == 0


def test_bpe_one_codec_per_task(spark):
    tokenizer = byte_bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    once = byte_bpe.digests(tokenizer.round_trip(edge_docs(spark)), tokenizer)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "ArrowEvalPython" not in plan
    twice = byte_bpe.digests(tokenizer.encode(edge_docs(spark)), tokenizer)
    assert Counter(once.collect()) == Counter(twice.collect()) and once.columns == twice.columns
    assert byte_bpe.digests(tokenizer.round_trip(empty_docs(spark)), tokenizer).count() == 0

    def codecs(batches):
        gc.collect()
        yield pd.DataFrame({"n": [sum(type(x).__name__ == "ByteBPE" for x in gc.get_objects())]})

    # a worker that goes on with other work keeps no codec
    assert spark.range(64).repartition(8).mapInPandas(codecs, "n long").agg(F.max("n")).first()[0] == 0


# --- mixing ---


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 3}" if i % 5 else None, 1) for i in range(400)] + [(None, "a b", "s1", 1), (3, None, "zz", 1), (9, "a b c", "big", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    found = mixing.mix(docs)
    got = found.collect()
    assert len(got) == len(rows) and found.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    per_target = {}
    for r in got:
        per_target.setdefault((r.source_size, r.target), []).append(r.taken)
    for (size, target), taken in per_target.items():
        assert target <= 2 * size
    total = sum(r.size for r in got)
    sources = {(r.source_size, r.target) for r in got}
    assert sum(t for _, t in sources) == pytest.approx(1.5 * total)
    assert sum(r.taken for r in got) == sum(math.floor(t) for _, t in sources)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_ranges_equal_one_window(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 7)
    assert sorted(map(str, mixing.mix(docs).collect())) == want


def test_mixed_copies(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 5), (2, "c c c c", "t", 6), (None, "d", "t", 7), (2, "c c c c", "t", 6)], "doc_id long, text string, source string, taken int")
    got = Counter(tuple(r) for r in mixing.mixed_copies(docs, weights=(1,), share=2.0).collect())
    assert got == Counter({(1, "a b", "s", 5): 2, (2, "c c c c", "t", 6): 4, (None, "d", "t", 7): 2})
