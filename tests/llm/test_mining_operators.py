"""Filter audit, phrases and packing against plain versions and edge rows."""

import random
import struct
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logloom.llm import collocations, filter_audit, packing
from tests.llm.test_text_operators import EDGES, edge_docs, empty_docs

# --- filter audit ---


def plain_audit(docs, labels):
    """Filter by filter, as the contract has it."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    failing = {}
    for at, (i, text, part) in enumerate(docs):
        text, words = text or "", (text or "").encode().split()
        failing[at] = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > first[text],
        }
    out, shares = {}, Counter()
    for part in {p or "" for _, _, p in docs}:
        mine = [at for at, d in enumerate(docs) if (d[2] or "") == part]
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                gone = [at for at in left if failing[at][name]]
                fails = [at for at in mine if failing[at][name]]
                left = [at for at in left if not failing[at][name]]
                shares[part, name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(fails) - len(gone), sum(sum(failing[at].values()) == 1 for at in fails),
                    sum(docs[at][0] in good for at in gone), sum(docs[at][0] in toxic for at in gone), (part, name),
                ]
    return {key: (*row[:-1], shares[row[-1]]) for key, row in out.items()}


def test_audit_equals_filtering(spark):
    rnd = random.Random(2)
    pool = [" ".join(f"w{rnd.randrange(n)}" for _ in range(size)) for n, size in ((5, 90), (500, 120), (60, 130), (900, 40))]
    pool += ["LOUD " * 120, "a#b " * 30, pool[1] + " %", None, "", " ", "É" * 200]
    docs = [(rnd.choice([None, *range(40)]), rnd.choice(pool), rnd.choice(["en", "de", None, ""])) for _ in range(160)]
    labels = [(rnd.choice([None, *range(40)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(30)]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, lang string, mask string, good int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r[:3]): tuple(r[3:]) for r in filter_audit.audit(table, marks).collect()}
    assert got == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty_docs(spark), marks).count() == 0
    rows = filter_audit.audit(edge_docs(spark), marks).collect()
    assert len(rows) == 600 and {r.good_lost for r in rows} == {0}


@pytest.mark.parametrize("size", range(1, 7))
def test_swaps_reach_every_order_once(size):
    order, seen = list(range(size)), set()
    seen.add(tuple(order))
    for at in filter_audit.swaps(size):
        order[at], order[at + 1] = order[at + 1], order[at]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert seen == set(permutations(range(size)))


# --- phrases ---


def plain_phrases(docs, top, least, longest):
    counts, total = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        data = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\n\x0b\x0c\r":
            data = data.replace(mark, "\n")
        for piece in data.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            total[lang] += len(words)
            for size in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in frequent.items():
            inside = [q for q in frequent if len(q) > len(p) and frequent[q] >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not inside:
                score, _, left, right = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, n, p.decode(), -a, left, right, total[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrase_docs():
    """Fixed phrases, rare words that stand alone, common words and every kind of separator."""
    rnd = random.Random(6)
    fixed = ["New York City", "par ex", "a b c d e f", "Ünder der Brücke", "x y", "rare pair here"]
    docs = []
    for _ in range(220):
        words = []
        for _ in range(rnd.randrange(25)):
            words.append(rnd.choice(fixed) if rnd.random() < 0.3 else f"w{int(rnd.expovariate(0.15))}" if rnd.random() < 0.8 else rnd.choice(["the", "of", "the of"]))
            words.append(rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0c"]))
        docs.append(("".join(words), rnd.choice(["en", "en", "en", "de", None])))
    return docs + [(None, "en"), ("", "de"), (" \t ", None), ("Solo", "fr"), ("the of " * 400, "en"), ("Solo", "fr")]


@pytest.mark.parametrize("how", [{}, {"first_share": 0.01, "growth": 2, "buffer": 50}, {"filter_bits": 6, "first_share": 0.02}, {"longest": 2}, {"longest": 3, "top": 7}, {"top": 100_000}])
def test_phrases_equal_counting_all(spark, how):
    """Few rounds and many, small buffers, and filters so full that almost everything passes."""
    mining = collocations.Mining(**{"top": 12, "least": 4, **how})
    docs = phrase_docs()
    table = spark.createDataFrame([(i % 50, *d, 0) for i, d in enumerate(docs)], "doc_id long, text string, lang string, n int")
    got = sorted(tuple(r) for r in collocations.mine(table, how=mining).collect())
    assert got == plain_phrases(docs, mining.top, mining.least, mining.longest)


def test_phrases_of_nothing(spark):
    assert collocations.mine(empty_docs(spark)).count() == 0
    assert collocations.mine(edge_docs(spark).where("doc_id < 6")).count() == 0
    # one endless text: every phrase is inside the longest ones
    rows = collocations.mine(edge_docs(spark)).collect()
    assert {(r.phrase, r.a) for r in rows} == {(" ".join(["the"] * k), 30_001 - k) for k in range(2, 6)}


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**13, 10**15, 10**13 + 7, 10**13 + 9)], "a long, n long, l long, r long")
    assert row.select(F.expr(collocations.SCORE)).first()[0] == 1000 * 10**13 * 10**15 // ((10**13 + 7) * (10**13 + 9))


def test_word_numbers_that_clash_are_drawn_anew(spark, monkeypatch):
    real, drawn = collocations._numbers_clash, []
    monkeypatch.setattr(collocations, "_numbers_clash", lambda v: drawn.append(real(v)) or len(drawn) == 1)
    docs = phrase_docs()
    table = spark.createDataFrame(docs, "text string, lang string")
    got = collocations.mine(table, how=collocations.Mining(top=5, least=6)).collect()
    assert drawn == [False, False] and sorted(map(tuple, got)) == plain_phrases(docs, 5, 6, 5)
    same = spark.createDataFrame([("en", b"a", 5), ("en", b"b", 5)], "lang string, word binary, number long")
    assert real(same) and not real(same.where("word = X'61'"))


# --- packing ---

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_the_histogram(seed):
    rnd = random.Random(seed)
    size = 64
    histogram = {rnd.randint(1, size): rnd.choice([1, 3, 50, 10_000]) for _ in range(30)} | {1: 5000 * (seed % 2)}
    found = packing.shortest_pack_first(histogram, size)
    held = Counter()
    for lengths, count in zip(found.lengths, found.counts):
        assert sum(lengths) <= size and count > 0 and list(lengths) == sorted(lengths, reverse=True)
        held.update({n: lengths.count(n) * count for n in set(lengths)})
    assert held == Counter({n: c for n, c in histogram.items() if c})
    assert len(found.counts) <= 3 * len(histogram)


def test_shortest_pack_comes_first():
    found = packing.shortest_pack_first({7: 2, 5: 1, 3: 2, 2: 1}, 10)
    assert sorted(zip(found.lengths, found.counts)) == [((5, 3), 1), ((7, 2), 1), ((7, 3), 1)]


def packed(spark, docs, size):
    rows = packing.pack(docs, PATH, size=size).collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = {}
    for r in docs.collect():
        codes = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        ids.setdefault(r.doc_id, []).append(codes)
    return rows, ids


@pytest.mark.parametrize("size", [8, 64, 1024])
def test_pieces_hold_every_id_once(spark, size):
    docs = edge_docs(spark).union(edge_docs(spark).where("doc_id <> 6").withColumn("doc_id", F.col("doc_id") + 50))
    rows, ids = packed(spark, docs, size)
    want = Counter()
    for doc_id, texts in ids.items():
        for codes in texts:
            for start in range(0, len(codes), size):
                part = codes[start : start + size]
                want[doc_id, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(codes)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size


def test_packing_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows, _ = packed(spark, docs.limit(0), 1024)
    assert rows == []
    rows = packing.pack(docs, PATH).collect()
    used, packs = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert used / (1024 * packs) > 0.99


def test_word_encoder_equals_the_tokenizer():
    tokenizer, rnd = Tokenizer.from_file(PATH), random.Random(3)
    with open(PATH, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    bits = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "1", "é", ".", " ", "\u0301", "<|endoftext|>", "ab,", "x!", "\x1f", "\x85", "\u200b", "ß.", "漢,"]
    texts = ["".join(rnd.choice(bits) for _ in range(30)) for _ in range(800)] + [t or "" for _, t in EDGES] + ["word, " * 50, "x" * 3000, " ".join("abc" * i for i in range(60))]
    for text in texts * 2:
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_white_space_is_searched_in_new_words_only(monkeypatch):
    tokenizer, seen = Tokenizer.from_file(PATH), []
    with open(PATH, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    search = packing._spaces
    monkeypatch.setattr(packing, "_spaces", lambda text: seen.append(len(text)) or search(text))
    for text in ("a b\n", "q b\n c", "a\n b", "a  b", "a b ", "a b  ", "\n", "\n a", "one two three", "one two three", "one two four"):
        seen.clear()
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    assert seen == [len("four ")]


def test_long_texts_and_full_memos(monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    monkeypatch.setattr(packing, "LONG_TEXT", 40)
    monkeypatch.setattr(packing, "MEMO_BYTES", 2000)
    with open(PATH, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    rnd = random.Random(1)
    for size in (5, 30, 200, 7, 30):
        text = " ".join("".join(rnd.choice("abcdeé,") for _ in range(rnd.randint(0, 9))) for _ in range(size))
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
