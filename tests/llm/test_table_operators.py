"""Near-duplicates, curve search, archive, secrets and the pipeline against plain versions and edge rows."""

import hashlib
import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logloom.llm import curve_search, near_dedup, queries, secret_scan, warc
from logloom.llm.components import connected_components
from logloom.llm.hilbert import hilbert_keys
from logloom.llm.words import lower_words
from logloom.session import work_dir
from tests.llm.test_text_operators import EDGES, edge_docs, empty_docs

# --- near-duplicates ---


def shingles(text, size):
    w = lower_words(text)
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def plain_components(rows, size, percent=80):
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                a_root, b_root = root(a), root(b)
                parent[max(a_root, b_root)] = min(a_root, b_root)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_rows():
    """Chains, copies with a few words changed, groups around 0.8 and unrelated texts."""
    rnd = random.Random(8)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(60)]
    rows = []
    for i in range(90):
        copy = list(base)
        for _ in range(rnd.randint(0, 5)):
            copy[rnd.randint(0, 59)] = f"x{rnd.randint(0, 999)}"
        rows.append((1000 - i, " ".join(copy)))
    rows += [(2000 + i, " ".join(base[i : i + 40])) for i in range(12)]
    return rows + [(3000 + i, " ".join(f"z{rnd.randint(0, 99)}" for _ in range(30))) for i in range(30)]


@pytest.mark.parametrize("how", [{}, {"tile_from": 4, "tile": 8}, {"tile_from": 2, "hub_rounds": 1}])
def test_near_duplicates_equal_all_pairs(spark, how):
    rows = near_rows() + EDGES
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(docs, how=near_dedup.NearDedup(shingle=2, **how)).collect()
    assert len(found) == len(rows)
    want = plain_components(rows, 2)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)


def test_crowds_and_tiles_make_few_edges(spark, monkeypatch):
    sizes, plain = [], connected_components
    monkeypatch.setattr(near_dedup, "connected_components", lambda edges: sizes.append(edges.distinct().count()) or plain(edges))
    # 120 classes under the same 20 keys with hubs of their own
    rows = spark.createDataFrame([(key, rep, 120) for key in range(20) for rep in range(key, 120)], "key long, rep long, n long")
    found = near_dedup._crowds(rows, near_dedup.NearDedup(tile_from=4)).collect()
    assert {(r.rep, r.crowd) for r in found} == {(rep, 0) for rep in range(120)}
    assert sizes[0] < 120 + 20
    # all pairs of ten nodes hang together by nine of them
    left, right = np.triu_indices(10, 1)
    assert len(near_dedup._tree(left, right)) == 9


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(empty_docs(spark)).count() == 0
    assert near_dedup.near_duplicates(edge_docs(spark).where("text is null")).where("not kept").count() == 0


def test_every_pair_under_the_distance_meets():
    """The promise of the index: any two signatures within the distance share a key."""
    how, rnd = near_dedup.NearDedup(), random.Random(1)
    for _ in range(300):
        a = [rnd.randint(0, 9) for _ in range(how.places)]
        b = list(a)
        for place in rnd.sample(range(how.places), how.max_distance):
            b[place] += 10
        wrong = [sum(x != y for x, y in zip(a[c : c + how.width], b[c : c + how.width])) for c in range(0, how.places, how.width)]
        assert min(wrong) <= how.errors


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(rnd.randint(50, 90), rnd.randint(50, 90)) for _ in range(30)] + [(200, 100 + i) for i in range(30)] + [(7, 7), (None, 3)]
    parent = {i: i for e in edges for i in e if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in edges:
        if u is not None and v is not None:
            parent[max(root(u), root(v))] = min(root(u), root(v))
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: root(i) for i in parent if root(i) != i}


# --- curve search ---


def test_hilbert_curve_steps():
    for axes, bits in ((1, 4), (2, 3), (3, 2), (4, 2)):
        cells = np.array(list(product(range(1 << bits), repeat=axes)))
        keys = hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def plain_nearest(rows, k=10):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    length = Counter(len(v) for _, v in good).most_common(1)[0][0]
    good = [(i, v) for i, v in good if len(v) == length]
    out = {}
    for q, a in good:
        if q % 100 == 0:
            near = {}
            for i, b in good:
                if i != q:
                    near[i] = min(near.get(i, np.inf), float(np.sqrt(((a - b) ** 2).sum())))
            out[q] = sorted(near.items(), key=lambda p: (p[1], p[0]))[:k]
    return out


@pytest.mark.parametrize("folder, how", [("sf0.001", {}), ("sf0.01", {}), ("sf0.1", {}), ("sf0.1", {"least": 1})])
def test_curve_search_recall(spark, folder, how):
    """The tables given, as the query searches them; the largest by ranges of the curve as well."""
    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    got = curve_search.search(table, F.col("vec_id") % 100 == 0, how=curve_search.Curves(**how)).collect()
    want = plain_nearest([(r.vec_id, r.embedding) for r in table.collect()])
    hits = sum((r.query_id, r.vec_id) in {(q, i) for q, near in want.items() for i, _ in near} for r in got)
    assert len(got) == 10 * len(want) and hits >= 0.9 * len(got)
    exact = {(q, i): s for q, near in want.items() for i, s in near}
    assert all(r.score == pytest.approx(exact[r.query_id, r.vec_id], abs=1e-12) for r in got if (r.query_id, r.vec_id) in exact)


@pytest.mark.parametrize("n", [2, 11, 60])
def test_few_vectors_all_meet(spark, n):
    rnd = np.random.default_rng(n)
    rows = [(100 * i, rnd.normal(size=8).tolist()) for i in range(n)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in curve_search.search(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in near] for q, near in plain_nearest(rows).items()}


def test_windows_measure_less_than_all():
    """Distances over all orderings, per vector and query."""
    how, vectors = curve_search.Curves(), np.random.default_rng(2).normal(size=(20_000, 64))
    at = curve_search.Index(vectors[:10_000], how).blocks(vectors)
    met = [(np.abs(at - at[:, [q]]) <= 1).sum() / len(vectors) for q in range(0, 20_000, 200)]
    assert np.mean(met) < 1


def test_curve_search_edges(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=6).tolist()) for i in range(250)] + [(300 + i, [1.0] * 6) for i in range(80)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 6), (1003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1004, [float("nan")] * 6), (1005, [float("inf")] * 6), (1100, [1.0] * 5), (None, [1.0] * 6), (7, rows[7][1])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    how = curve_search.Curves(blocks=4, least=1, tile_rows=16, tile_queries=1)
    got = {}
    for r in curve_search.search(table, F.col("vec_id") % 100 == 0, how=how).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = plain_nearest(rows)
    assert got.keys() == want.keys() == {0, 100, 200, 300}
    assert [i for i, _ in got[300]] == [i for i, _ in want[300]]  # ties to the smaller id
    assert sum(len(set(a) & set(b)) for a, b in ((dict(got[q]), dict(want[q])) for q in want)) >= 36
    assert curve_search.search(table.limit(0), F.lit(True)).count() == 0
    assert curve_search.search(table.where("vec_id = 5"), F.lit(True)).count() == 0


def test_curve_search_of_repeated_ids(spark):
    """Rows that repeat an id, with the same or with other vectors, take no place of another id."""
    rnd = np.random.default_rng(9)
    rows = [(i, rnd.normal(size=6).tolist()) for i in range(60)] * 3
    rows += [(77, (np.array(rows[0][1]) + rnd.normal(size=6) / 100).tolist()) for _ in range(150)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for tile_rows in (2048, 20):
        how = curve_search.Curves(orderings=1, blocks=1, tile_rows=tile_rows)
        got = {r.rank: (r.vec_id, r.score) for r in curve_search.search(table, F.col("vec_id") == 0, how=how).collect()}
        want = plain_nearest(rows)[0]
        assert [got[k + 1][0] for k in range(10)] == [i for i, _ in want] and len(got) == 10
        assert [got[k + 1][1] for k in range(10)] == pytest.approx([d for _, d in want], abs=1e-12)
    raw = np.array([np.array(v).tobytes() for _, v in rows[180:]], object)
    dealt = curve_search._spread(curve_search._row_hashes(np.full(150, 77), raw), np.full(150, 8))
    assert np.bincount(dealt, minlength=8).max() < 40  # one id does not fill one tile


# --- archive ---


def test_archive_round_trip(spark):
    long = "x" * 1200
    rows = [(1, "http://a/\r\n1", long), (5, "u", long), (5, "u", long), (3, None, long), (2, "u", "short"), (4, "u", "short"), (6, "u", None), (7, "u", ""), (None, "n", long), (8, "u", "é" * 600)]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    records = warc.read_archive(spark, warc.write_archive(pages, work_dir(spark, "warc")))
    got = Counter(tuple(r) for r in warc.parse_records(records).drop("target_uri").collect())
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        owner = max((p for p, _, h in rows if p is not None and h == html), default=None) if len(data) >= 1000 else None
        again = page is not None and owner is not None and page < owner
        want[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", owner if again else None)] += 1
    assert got == want
    for raw in records.select(warc.record_bytes().alias("b")).collect():
        head, _, rest = bytes(raw.b).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert len(rest) == size + 4
    assert warc.read_archive(spark, warc.write_archive(pages.limit(0), work_dir(spark, "warc"))).count() == 0


# --- secrets ---


def secret_docs(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(120):
        words = [rnd.choice(["the", "word", "other", "plain", "text", "extraordinarily", "incomprehensibilities"]) for _ in range(40)]
        key = "".join(rnd.choice("0123456789abcdef") for _ in range(32))
        words.insert(7, [f"token={key}", f'password = "{key}"', "4" + "".join(rnd.choice("0123456789") for _ in range(15)), "a/long/path/to/some/file.txt"][i % 4])
        rows.append((i, " ".join(words), key, i % 4))
    return spark.createDataFrame(rows, "doc_id long, text string, value string, label int")


def test_secret_scan_finds_and_masks(spark):
    docs = secret_docs(spark)
    found = secret_scan.scan(docs, F.col("doc_id") % 3 == 1)
    flagged = {(r.doc_id, r.value) for r in found.where("is_secret").collect()}
    assert flagged == {(r.doc_id, r.value) for r in docs.collect() if r.label < 2}
    masked = {r.doc_id: r.text for r in secret_scan.redact(docs, found).collect()}
    for r in docs.collect():
        assert masked[r.doc_id] == (r.text.replace(r.value, "[secret]") if r.label < 2 else r.text)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_secret_scan_edges(spark):
    docs = edge_docs(spark).withColumn("value", F.lit(1))
    assert secret_scan.scan(docs).count() == 0 and secret_scan.scan(empty_docs(spark)).count() == 0
    one = spark.createDataFrame([(None, "token=0123456789abcdef0123"), (1, None)], "doc_id long, text string")
    found = secret_scan.scan(one)
    assert [(r.doc_id, r.value, r.is_secret) for r in found.collect()] == [(None, "0123456789abcdef0123", True)]
    assert {r.text for r in secret_scan.redact(one, found).collect()} == {"token=[secret]", None}


ASSIGNED = [
    ("so password=Tr0ub4dor&3 it is", 1, "Tr0ub4dor&3", "so password=[secret] it is"),
    ("x2 pwd: x2, and x2", 2, "x2", "x2 pwd: [secret], and x2"),
    ('a {"api_key": "a.b$c9!d"} z', 2, "a.b$c9!d", 'a {"api_key": "[secret]"} z'),
    ("-H 'Authorization: Bearer ab.cd9.ef' go", 3, "ab.cd9.ef", "-H 'Authorization: Bearer [secret]' go"),
    ('passphrase = "4 horse  staples" end', 2, "4 horse  staples", 'passphrase = "[secret]" end'),
    ("p secret=a secret=\\Eb7 t", 2, "\\Eb7", None),
]


def test_secret_scan_of_assigned_values(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, *_) in enumerate(ASSIGNED)], "doc_id long, text string")
    found = secret_scan.candidates(docs)
    got = {(r.id, r.place, r.value) for r in found.collect()}
    assert got == {(i, place, value) for i, (_, place, value, _) in enumerate(ASSIGNED)} | {(5, 1, "a")}
    plain = secret_docs(spark).where("label > 1").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    scanned = secret_scan.scan(docs.union(plain))
    flagged = {(r.doc_id, r.value) for r in scanned.where("is_secret").collect()}
    assert {(i, value) for i, (_, _, value, _) in enumerate(ASSIGNED)} <= flagged and all(i < 100 for i, _ in flagged)
    masked = {r.doc_id: r.text for r in secret_scan.redact(docs, scanned).collect()}
    assert all(masked[i] == text for i, (*_, text) in enumerate(ASSIGNED) if text) and masked[5].endswith("secret=[secret] t")


def test_secret_labels_leave_doubt_open(spark):
    keys = ["ghp_" + "a1B2c3" * 6, "sk_" + "live_" + "4eC39HqLyjWDarjtT1", "xoxb-" + "123456789012-abcDEF", "AIza" + "Sy0_-aB" * 5]
    values = [(k, 1.0) for k in keys] + [("q8Zt4Lw0Xk2Pv6Rb1Nc", None), ("incomprehensibilities", 0.0), ("4111111111111111", 0.0), ("--------------------", 0.0)]
    docs = spark.createDataFrame([(i, f"see {v} here") for i, (v, _) in enumerate(values)] + [(90, "token: string"), (91, "token: swordfish")], "doc_id long, text string")
    got = {r.id: r.label for r in secret_scan.label_by_rule(secret_scan.candidates(docs)).collect()}
    assert got == {**{i: label for i, (_, label) in enumerate(values)}, 90: 0.0, 91: None}


# --- pipeline and registration ---


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        path = work_dir(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert place == 4 or docs.columns == columns
        if name == "near_dedup":
            want = plain_components([(r.doc_id, r.text) for r in before.collect()], 5)
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in want.items() if i == c}
        if name == "secret_scan":
            assert docs.count() == before.count()
    assert docs.count() > 0
    assert corpus_pipeline.run(spark, folder).count() == docs.count()


LONG = " ".join(f"word{i}" for i in range(50))
#: doc_id, text, lang, source of rows for which each stage has one right answer.
ODD = [
    (1, LONG, "en", "s"), (2, LONG, "en", "s"), (2, "other words of a text", None, "s"), (3, "one row twice over", "en", "s"),
    (3, "one row twice over", "en", "s"), (None, "a row without an id", None, None), (None, LONG, "en", "s"), (5, None, "en", "s"),
    (6, "12 34", "en", "s"), (7, "", None, None), (None, "a row without an id", None, None),
]


def odd_docs(spark):
    return spark.createDataFrame([(*r, 0) for r in ODD], "doc_id long, text string, lang string, source string, n_chars long")


def rows_of(df, n=4):
    return Counter(tuple(r)[:n] for r in df.collect())


def test_language_stage_of_odd_rows(spark):
    left = Counter(r for r in ODD if r[1] and any(c.isalpha() for c in r[1]))
    # every label held out or null: nothing is learned, and nothing with a letter is lost
    unlabelled = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = rows_of(corpus_pipeline.identify_language(spark, unlabelled, ""))
    assert kept == Counter(Counter({(i, t, None, s): 0 for i, t, _, s in left})) + Counter((i, t, None, s) for i, t, _, s in left.elements())
    # with one language learned, null languages are filled
    kept = rows_of(corpus_pipeline.identify_language(spark, odd_docs(spark), ""))
    assert kept == Counter((i, t, "en", s) for i, t, _, s in left.elements())


def test_near_dedup_stage_of_odd_rows(spark):
    kept = rows_of(corpus_pipeline.near_dedup_documents(spark, odd_docs(spark), ""))
    want = {ODD[0], ODD[2], ODD[3], ODD[5], ODD[8]}  # one of each group, id and text together
    assert kept == Counter(want) + Counter([ODD[7], ODD[9]])  # no words, linked with nothing


def test_mixing_stage_of_odd_rows(spark):
    docs = odd_docs(spark)
    kept = rows_of(corpus_pipeline.mix_sources(spark, docs, ""))
    assert set(kept) <= set(ODD) and all(r[1] for r in kept)
    assert kept[ODD[5]] == 4  # a source of its own, taken twice over: rows without an id take part


def test_pipeline_of_edges(spark, tmp_path):
    odd_docs(spark).write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    # what is left of ODD after the first two stages, as often as its source takes it
    assert {r.doc_id for r in got} <= {1, 2, 3, 6, None} and None in {r.doc_id for r in got}
    odd_docs(spark).limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
