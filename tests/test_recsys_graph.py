import random
from itertools import combinations

from pyspark.sql import functions as F

from logloom.operators import graph, recsys
from logloom.sources.readers import read_preferences

# each base lists related items, and bases are items themselves
PREFS = [
    (101, 102), (101, 103), (102, 101), (102, 104), (102, 106), (103, 101), (103, 108), (111, 112),
]


def brute(prefs, k):
    owned = {}
    for b, i in prefs:
        owned.setdefault(b, set()).add(i)
    holders = {}
    for b, i in prefs:
        holders.setdefault(i, set()).add(b)
    sim = {}
    for a, b in combinations(sorted(holders), 2):
        both = holders[a] & holders[b]
        if both:
            sim[a, b] = len(both) / len(holders[a] | holders[b])
    recs = {}
    for base, items in owned.items():
        score = {}
        for i in items:
            for (a, b), s in sim.items():
                for mine, other in ((a, b), (b, a)):
                    if mine == i and other not in items and other != base:
                        score[other] = score.get(other, 0) + s
        best = sorted(score.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
        recs.update({(base, i): round(s, 9) for i, s in best})
    return sim, recs


def check(spark, prefs, **kw):
    df = spark.createDataFrame(prefs, "base_id LONG, item_id LONG")
    sim, recs = brute(prefs, 4)
    got = {(r.item_a, r.item_b): r.similarity for r in recsys.item_similarity(df).collect()}
    assert got == sim and all(0 < s <= 1 for s in got.values())
    for size in ({}, {"bucket_prefs": 7, "panel_items": 3}):
        rows = recsys.recommend(df, **size).collect()
        assert {(r.base_id, r.item_id): r.relevance for r in rows} == recs
        assert len(rows) == len(recs)


def test_a_base_larger_than_a_bucket(spark):
    """A base with a third of all preferences is dealt into slices and has the same result."""
    rng = random.Random(5)
    prefs = sorted({(rng.randrange(40), rng.randrange(60)) for _ in range(90)} | {(3, i) for i in range(0, 90, 2)})
    _, recs = brute(prefs, 4)
    df = spark.createDataFrame(prefs, "base_id LONG, item_id LONG")
    for size in (5, 20, 44, 10_000):
        rows = recsys.recommend(df, bucket_prefs=size, panel_items=4).collect()
        assert {(r.base_id, r.item_id): r.relevance for r in rows} == recs


def test_top_neighbours(spark):
    df = spark.createDataFrame(PREFS, "base_id LONG, item_id LONG")
    sim, _ = brute(PREFS, 4)
    ways = {}
    for (a, b), s in sim.items():
        ways.setdefault(a, []).append((-round(s, 9), b))
        ways.setdefault(b, []).append((-round(s, 9), a))
    want = {(i, o, -s, n) for i, near in ways.items() for n, (s, o) in enumerate(sorted(near)[:2], 1)}
    assert {tuple(r) for r in recsys.top_neighbours(recsys.item_similarity(df), 2).collect()} == want


def test_scores_in_small_chunks(spark, monkeypatch):
    # the scorer sees the constant through its globals, so it is called directly
    import pandas as pd

    monkeypatch.setattr(recsys, "CELL_ENTRIES", 3)
    rng = random.Random(8)
    prefs = sorted({(rng.randrange(9), rng.randrange(12)) for _ in range(50)})
    sim, recs = brute(prefs, 4)
    both = [(a, b, s) for (a, b), s in sim.items()] + [(b, a, s) for (a, b), s in sim.items()]
    owned = pd.DataFrame([(b, i, h) for b, i in prefs for h in (0, 1)], columns=["base_id", "item_id", "_held"]).assign(sliced=False)
    sims = pd.DataFrame(both, columns=["_item", "other_id", "similarity"])
    out = recsys._panel_scorer(4, 9)(owned, sims)
    got = {(int(b), int(i)): r for b, i, r, _ in out.itertuples(index=False)}
    assert got == recs


def test_small_model(spark):
    check(spark, PREFS + PREFS[:3])


def test_random_model(spark):
    rng = random.Random(3)
    prefs = [(rng.randrange(12), rng.randrange(15)) for _ in range(60)]
    check(spark, prefs + [(99, i) for i in range(15)])


def test_large_baskets_are_cut_into_blocks(spark):
    rng = random.Random(4)
    prefs = [(b, rng.randrange(40)) for b in range(6) for _ in range(20)] + [(9, i) for i in range(40)]
    df = spark.createDataFrame(prefs, "base_id LONG, item_id LONG")
    want = {}
    for b in {b for b, _ in prefs}:
        for pair in combinations(sorted({i for c, i in prefs if c == b}), 2):
            want[pair] = want.get(pair, 0) + 1
    for size in (1, 7, 1000):
        rows = recsys.cooccurrence(df, block_items=size).collect()
        assert {(r.item_a, r.item_b): r.together for r in rows} == want
        assert len(rows) == len(want)


def test_preferences_file(spark, tmp_path):
    (tmp_path / "p.csv").write_text("1,2,1\n1,3,1\n2,3,1\n")
    rows = read_preferences(spark, str(tmp_path / "p.csv")).collect()
    assert [tuple(r) for r in rows] == [(1, 2), (1, 3), (2, 3)]


def brute_paths(edges, max_len):
    edges = set(edges)
    level = [[e] for e in edges]
    found = []
    for _ in range(max_len):
        found += level
        level = [p + [e] for p in level for e in edges if p[-1][1] == e[0] and e not in p]
    return sorted([p[0][0]] + [e[1] for e in p] for p in found)


def paths(spark, edges, max_len):
    df = spark.createDataFrame(edges, "src STRING, dst STRING")
    return sorted(r.path for r in graph.enumerate_paths(df, max_len).collect())


def test_paths_of_a_tree(spark):
    edges = [("1", "2"), ("1", "3"), ("3", "4"), ("4", "5")]
    got = paths(spark, edges, 10)
    assert len(got) == 7 and got == brute_paths(edges, 10)
    assert ["1", "3", "4", "5"] in got


def test_paths_of_a_cycle_and_duplicates(spark):
    edges = [("a", "b"), ("b", "a"), ("a", "b"), ("b", "c"), ("c", "c")]
    for n in (1, 2, 6):
        assert paths(spark, edges, n) == brute_paths(edges, n)
    assert len(paths(spark, [("a", "b"), ("b", "a")], 5)) == 4


def test_paths_through_a_page_that_many_reach_late(spark):
    # few edges lead to "h", but nearly all paths of two edges end there
    edges = [(f"s{i}", "m") for i in range(40)] + [("m", "h"), ("h", "m"), ("h", "z")]
    for n in (2, 3, 5):
        assert paths(spark, edges, n) == brute_paths(edges, n)


def test_graph(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "b")], "src STRING, dst STRING")
    nodes, edges = graph.build_graph(df)
    assert nodes.count() == 2 and edges.count() == 2
    assert nodes.where(F.col("page") == "a").count() == 1


def test_pairs_are_counted_where_their_baskets_are_sent(spark, monkeypatch):
    """Many tasks and a common item give the same counts, and no row per pair is shuffled."""
    monkeypatch.setattr(recsys, "TASK_PAIRS", 40)
    rng = random.Random(6)
    prefs = sorted({(rng.randrange(30), rng.randrange(25)) for _ in range(150)} | {(b, 7) for b in range(200)} | {(9, i) for i in range(30)})
    want = {}
    for b in {b for b, _ in prefs}:
        for pair in combinations(sorted({i for c, i in prefs if c == b}), 2):
            want[pair] = want.get(pair, 0) + 1
    df = spark.createDataFrame(prefs, "base_id LONG, item_id LONG")
    for size in (4, 1000):
        found = recsys.cooccurrence(df, block_items=size)
        rows = found.collect()
        assert {(r.item_a, r.item_b): r.together for r in rows} == want
        assert len(rows) == len(want)
    plan = found._jdf.queryExecution().toString()
    assert "hashpartitioning(_part" in plan and "hashpartitioning(item_a" not in plan


def test_bases_that_share_items_lie_in_one_bucket(spark):
    """Copies of one model under other ids need as many lists each as the model alone."""
    rng = random.Random(7)
    model = sorted({(rng.randrange(40), rng.randrange(12)) for _ in range(200)})
    found = []
    for copies in (1, 4):
        prefs = [(b + 1000 * c, i + 1000 * c) for c in range(copies) for b, i in model]
        owned = spark.createDataFrame(prefs, "base_id LONG, item_id LONG")
        places = recsys._places(owned, 60)
        assert places.groupBy("base_id", "_slice").count().where("count > 1").isEmpty()
        found.append(owned.join(places, "base_id").select("bucket", "item_id").distinct().count())
    assert found[1] <= 1.5 * 4 * found[0]


def test_pairs_travel_packed_and_few_reach_the_sort(spark):
    """Baskets move as packed runs, and a task leaves k pairs of an item; the nearest are the same in small chunks."""
    rng = random.Random(9)
    prefs = sorted({(rng.randrange(30), rng.choice((1, -1)) * rng.randrange(40) * 10**9) for _ in range(400)})
    df = spark.createDataFrame(prefs, "base_id LONG, item_id LONG")
    sim, _ = brute(prefs, 4)
    ways = {}
    for (a, b), s in sim.items():
        ways.setdefault(a, []).append((-round(s, 9), b))
        ways.setdefault(b, []).append((-round(s, 9), a))
    want = {(i, o, -s, n) for i, near in ways.items() for n, (s, o) in enumerate(sorted(near)[:3], 1)}
    found = recsys.top_neighbours(recsys.item_similarity(df), 3)
    assert {tuple(r) for r in found.collect()} == want
    plan = found._jdf.queryExecution().toString()
    assert "_packed" in plan and plan.split("== Physical Plan ==")[1].count("MapInArrow") >= 3
    frame = df.sparkSession.createDataFrame([(1, 2, None), (1, 3, float("nan")), (2, 3, 0.5), (None, 3, 0.7)], "item_a LONG, item_b LONG, similarity DOUBLE")
    odd = {tuple(map(str, r)) for r in recsys.top_neighbours(frame, 2).collect()}
    assert odd == {tuple(map(str, r)) for r in recsys.top_neighbours(frame.withColumn("item_a", F.col("item_a").cast("int")), 2).collect()}
    assert len(odd) == 7


def test_runs_are_counted_in_chunks(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from logloom.plans import packed

    rng = random.Random(10)
    baskets = [sorted(rng.sample(range(0, 300, 7), rng.randrange(1, 20))) for _ in range(60)]
    want = {}
    for basket in baskets:
        for pair in combinations(basket, 2):
            want[pair] = want.get(pair, 0) + 1
    column = pa.array(baskets, pa.list_(pa.int64()))
    none = pa.array([None] * 60, pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([column, column, none, none], ["_own", "_ns", "_ids", "_other_ns"])
    for entries in (4_000_000, 8):
        monkeypatch.setattr(recsys, "CELL_ENTRIES", entries)
        parts = {}
        for out in recsys._dealer(np.array([0, 40, 200]), np.array([1, 3, 2]))([batch.slice(i, 7) for i in range(0, 60, 7)]):
            for part, salt, value in zip(*out.to_pydict().values()):
                parts.setdefault((part, salt), []).append(value)
        assert len(parts) == 6
        found = [tuple(map(int, row)) for values in parts.values() for rows in recsys._counted(values) for row in zip(*rows)]
        assert {(a, b): n for a, b, n, _, _ in found} == want and len(found) == len(want)
        assert all((x, y) == (a, b) for a, b, _, x, y in found)
    big = np.array([3, -(2**62), 2**62, 2**63 - 1, -(2**63)])
    assert [a.tolist() for a in packed.unpack(packed.pack(big, big[:0], big / 7))] == [big.tolist(), [], (big / 7).tolist()]


def test_similarities_and_preferences_travel_packed(spark):
    """Lists and preferences are bundled per cell, and similarities given as numbers have the same result."""
    rng = random.Random(12)
    prefs = sorted({(rng.randrange(25), rng.randrange(30) * 10**12 - 10**13) for _ in range(160)})
    sim, recs = brute(prefs, 4)
    df = spark.createDataFrame(prefs, "base_id LONG, item_id LONG")
    given = spark.createDataFrame([(a, b, s) for (a, b), s in sim.items()], "item_a LONG, item_b LONG, similarity DOUBLE")
    for kw in ({}, {"similarity": given}, {"bucket_prefs": 3, "panel_items": 2}):
        rows = recsys.recommend(df, **kw).collect()
        assert {(r.base_id, r.item_id): r.relevance for r in rows} == recs and len(rows) == len(recs)


def test_bundles_grow_less_than_their_lists(spark):
    import numpy as np
    import pyarrow as pa

    from logloom.plans import packed

    rng = np.random.default_rng(1)
    n, rows = rng.integers(300, 400, 500), []
    for i in range(100):
        together = rng.integers(1, 6, 500)
        lists = [[np.arange(500) * 3], [together], [n + n[i] - together]]
        batch = pa.RecordBatch.from_arrays([pa.array([i]), pa.array([0], pa.int32()), *[pa.array(x) for x in lists]], ["item_id", "panel", "_others", "_nums", "_dens"])
        rows += [r.column("_list")[0].as_py() for r in recsys._packed_lists([batch])]
    table = pa.RecordBatch.from_arrays([pa.array([7] * 100), pa.array([0] * 100, pa.int32()), pa.array(range(100)), pa.array(rows, pa.binary())], ["_bucket", "_panel", "_item", "_list"])
    (out,) = packed.bundled(["_bucket", "_panel"], "_item", "_list")([table])
    values = out.column("_bundle").to_pylist()
    assert list(packed.unbundled(values)) == list(enumerate(rows))
    # 16 bytes an entry as an id and a quotient
    assert len(values) == 1 and len(values[0]) < 50_000
