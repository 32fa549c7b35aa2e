import random

from pyspark.sql import functions as F

from logloom.operators import aggregates, cleaning, joins


def test_tag_flags_and_labels(spark):
    many = ",".join(["747"] + [f"t{i}" for i in range(15)])
    rows = [(1, "747,a380"), (2, None), (3, many), (4, "7474"), (5, ",".join(["747"] + ["x"] * 14))]
    df = spark.createDataFrame(rows, "id INT, tags STRING")
    flags = cleaning.tag_flags(df, ["747", "a380"])
    got = {r.id: (r.num_tags, r.is_747, r.is_a380) for r in flags.collect()}
    assert got == {1: (2, 1, 1), 2: (1, 0, 0), 3: (16, 0, 0), 4: (1, 0, 0), 5: (15, 1, 0)}
    labels = {(r.id, r.AircraftModel) for r in cleaning.flag_labels(flags, ["747", "a380"]).collect()}
    assert labels == {(1, "B747"), (1, "A380"), (5, "B747")}


def test_photo_columns(spark):
    df = spark.createDataFrame(
        [("a+b", None, "http://h/x.y.jpg", "L1")],
        "desc STRING, tags STRING, ImageURL STRING, Attribution STRING",
    )
    r = cleaning.photo_columns(df).first()
    assert (r.desc, r.tags, r.ImageURL) == ("a b", "", "http://h/x.y_b.jpg")
    import hashlib

    assert r.image_file_name == hashlib.md5(b"http://h/x.y_b.jpg").hexdigest() + ".jpg"
    assert cleaning.with_license(df, "L1").count() == 1


def test_simple_filters(spark):
    df = spark.createDataFrame(
        [(1, 24, "a.jpg", "female"), (2, 30, "b.JPG", "male"), (3, None, "jpg", None)],
        "id INT, age INT, name STRING, gender STRING",
    )
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(cleaning.rows_in(df, "age", [24, 25])) == [1]
    assert ids(cleaning.complete_rows(df, ["age", "gender"])) == [1, 2]
    assert ids(cleaning.without_value(df, "age")) == [3]
    assert ids(df.where(cleaning.allowed_extension(F.col("name"), ["jpg", "png"]))) == [1]
    assert ids(cleaning.filled(df, {"age": 24}).where("age = 24")) == [1, 3]
    recoded = cleaning.recode(df, "gender", {"female": 2, "male": 1})
    assert [r.gender for r in recoded.orderBy("id").collect()] == [2, 1, None]
    assert cleaning.shaped(df, ["years", "id"], {"age": "years"}).columns == ["years", "id"]
    files = spark.createDataFrame([("a", 10240), ("b", 10239)], "path STRING, length LONG")
    assert [r.path for r in cleaning.min_size(files, 10).collect()] == ["a"]
    faces = spark.createDataFrame([(1,), (1,), (2,)], "id INT")
    assert ids(cleaning.drop_multi_detection(df, faces, "id")) == [2, 3]


def test_dedup_and_merge(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "k STRING, o INT, v STRING")
    first = {(r.k, r.v) for r in cleaning.dedup_keep(df, ["k"], ["o"]).collect()}
    last = {(r.k, r.v) for r in cleaning.dedup_keep(df, ["k"], ["o"], "last").collect()}
    assert first == {("k", "a"), ("j", "c")} and last == {("k", "b"), ("j", "c")}
    plan = cleaning.dedup_keep(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # reduced before and after the shuffle
    new = spark.createDataFrame([("k", "new"), ("n", "new")], "k STRING, v STRING")
    old = spark.createDataFrame([("k", "old"), ("o", "old")], "k STRING, v STRING")
    keep = lambda p: {(r.k, r.v) for r in cleaning.merge_previous(new, old, ["k"], p).collect()}
    assert keep("old") == {("k", "old"), ("n", "new"), ("o", "old")}
    assert keep("new") == {("k", "new"), ("n", "new"), ("o", "old")}


def test_key_joins(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id INT")
    b = spark.createDataFrame([(2, "x", 2), (2, "w", 1), (4, "y", 1)], "id INT, v STRING, o INT")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(joins.keep_listed(a, b, "id")) == [2, 2]
    assert ids(joins.exclude_listed(a, b, "id")) == [1, 3]
    assert len(joins.inner_on(a, b, "id").collect()) == 4
    assert len(joins.attach(a, b.where("o = 1"), "id").collect()) == 4
    stores = [b, spark.createDataFrame([(1,)], "id INT")]
    assert ids(joins.missing_from(a, stores, "id")) == [3]
    assert ids(joins.present_in(a, stores, "id")) == [1, 2, 2]
    firsts = joins.lookup_first(a.distinct(), b, "id", ["o"], ["v"])
    assert [tuple(r) for r in firsts.collect()] == [(2, "w")]


def osa(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_fuzzy_join_equals_brute_force(spark):
    rng = random.Random(5)
    stems = ["ab", "abcd", "kailahun", "kenema bo", "x" * 3, ""]
    stems += ["".join(rng.choice("abc") for _ in range(n)) for n in (5, 9, 63, 64, 65, 66, 67, 90)]

    def distort(s, times):
        for _ in range(times):
            i = rng.randrange(len(s) + 1)
            kind = rng.randrange(4)
            if kind == 0:
                s = s[:i] + rng.choice("abcz") + s[i:]
            elif kind == 1:
                s = s[:i] + s[i + 1 :]
            elif kind == 2:
                s = s[:i] + rng.choice("abcz") + s[i + 1 :]
            else:
                s = s[:i] + s[i : i + 2][::-1] + s[i + 2 :]
        return s

    right = [(g, s, n) for g in ("A", "B") for n, s in enumerate(stems)]
    left = []
    for i in range(150):
        g, s, _ = rng.choice(right)
        left.append((i, g, distort(s, rng.randrange(5))))
    left += [(1000 + i, "A", "kailahnu") for i in range(80)] + [(2000, "A", None), (2001, "C", "ab")]
    ldf = spark.createDataFrame(left, "id INT, country STRING, district STRING")
    rdf = spark.createDataFrame(right, "country STRING, name STRING, ord INT")
    out = joins.fuzzy_join(ldf, rdf, "district", "name", "country", "ord").collect()
    got = {r.id: (r.matched, r.distance) for r in out}
    assert len(out) == len(got)
    want = {}
    for i, g, s in left:
        if s is None:
            continue
        near = [(osa(s, t), n, t) for h, t, n in right if h == g]
        near = min([x for x in near if x[0] <= 2], default=None)
        if near:
            want[i] = (near[2], near[0])
    assert got == want and got[1000] == ("kailahun", 1)


def test_distance_is_exact_up_to_its_limit(spark):
    rng = random.Random(7)
    words = ["", "a", "ab", "ba", "\u00e9\U0001f600b", "b\x00"]
    words += ["".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(40)]
    pairs = [(a, b) for a in words for b in words] + [("x" * 3000 + "ab", "x" * 3000 + "ba")]
    df = spark.createDataFrame(pairs, "a STRING, b STRING").repartition(3)
    for limit in (0, 1, 2, 3):
        got = df.select("a", "b", joins.swap_aware_distance(limit)("a", "b").alias("d")).collect()
        assert all(r.d == min(limit + 1, osa(r.a, r.b) if len(r.a) < 100 else 1) for r in got)


def test_long_names_that_share_most_pieces(spark):
    stem = "university hospital of the northern district, department of tropical medicine, ward "
    left = [(i, "A", f"{stem}{i:04d}x") for i in range(300)]
    right = [("A", f"{stem}{i:04d}", i) for i in range(0, 300, 3)] + [(None, "n", 1)]
    ldf = spark.createDataFrame(left + [(900, None, "n")], "id INT, country STRING, district STRING")
    rdf = spark.createDataFrame(right, "country STRING, name STRING, ord INT")
    got = {r.id: (r.matched, r.distance) for r in joins.fuzzy_join(ldf, rdf, "district", "name", "country", "ord").collect()}
    for i, _, s in left:
        near = min((osa(s[-6:], t[-5:]), o, t) for _, t, o in right[:-1])
        assert got.get(i) == ((near[2], near[0]) if near[0] <= 2 else None)
    assert 900 not in got


def test_geo_ip_of_large_tables_and_one_frequent_address(spark):
    blocks = spark.createDataFrame(
        [("AA", "0.0.0.0/0"), ("BB", "9.0.0.0/8"), ("CC", "9.1.0.0/16"), ("CB", "9.1.0.0/16"), ("DD", "9.1.2.3/32")],
        "country STRING, cidr STRING",
    )
    rows = [(i, "9.1.2.3") for i in range(300)] + [(1000 + i, None) for i in range(400)]
    rows += [(2000 + i, f"9.{i % 3}.2.{i}") for i in range(200)] + [(3000, "x"), (3001, "255.255.255.255")]
    df = spark.createDataFrame(rows, "id INT, ip STRING")
    kept = {r.id: r.country for r in joins.geo_ip(df, "ip", blocks).collect()}
    dealt = joins.geo_ip(df, "ip", blocks, broadcast_blocks=0)
    assert {r.id: r.country for r in dealt.collect()} == kept and dealt.count() == len(rows)
    assert kept[0] == "DD" and kept[1000] is None and kept[2001] == "CB" and kept[2002] == "BB" and kept[3001] == "AA"
    none = joins.geo_ip(df, "ip", blocks.where("false"))
    assert none.where("country IS NOT NULL").count() == 0 and none.count() == len(rows)


def test_geo_ip(spark):
    blocks = spark.createDataFrame(
        [("AU", "1.0.0.0/24"), ("CN", "1.0.0.0/8"), ("SG", "10.1.255.7/15"), ("XX", "bad")],
        "country STRING, cidr STRING",
    )
    ips = ["1.0.0.9", "1.0.1.0", "1.255.255.255", "2.0.0.0", "10.0.0.1", "10.1.255.255", "x", None, "1.0.0.300"]
    df = spark.createDataFrame([(i,) for i in ips], "ip STRING")
    got = {r.ip: r.country for r in joins.geo_ip(df, "ip", blocks).collect()}
    assert got == {
        "1.0.0.9": "AU", "1.0.1.0": "CN", "1.255.255.255": "CN", "2.0.0.0": None,
        "10.0.0.1": "SG", "10.1.255.255": "SG", "x": None, None: None, "1.0.0.300": None,
    }


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.7), ("b", 0.9), (None, 0.1)], "c STRING, s DOUBLE")
    assert [tuple(r) for r in aggregates.class_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    a = [r for r in aggregates.score_summary(df, ["c"], "s").collect() if r.c == "a"][0]
    assert (round(a["mean"], 6), round(a["std"], 6), a["best"]) == (0.6, 0.1, 0.7)
    dates = spark.createDataFrame([("2014-06-18",), ("2014-03-01",)], "d STRING")
    assert aggregates.latest_date(dates, "d").first().latest_date == "18 Jun 2014"
    preds = spark.createDataFrame([("a", "a"), ("b", "a"), (None, None), (None, "b")], "p STRING, l STRING")
    assert aggregates.mismatch_percent(preds, "p", "l").first().mismatch_pct == 50.0
    assert tuple(aggregates.size_of(df).first()) == (4, 2)
    assert len(aggregates.distinct_values(df, "c").collect()) == 3
    assert len(aggregates.preview(df, 2).collect()) == 2
    top = aggregates.top_rows(df, [F.desc("s")], 1).first()
    assert top.c == "b"
    rank = {r.s: r["rank"] for r in aggregates.ranked_by_score(df, "s", ["c"], bands=3).collect()}
    assert rank == {0.9: 1, 0.7: 2, 0.5: 3, 0.1: 4}


def test_boxes_and_predictions(spark):
    boxes = spark.createDataFrame(
        [(1, 0, 1, 1, 2, 3), (1, 1, 2, 2, 3, 2), (2, 0, 5, 5, 1, 1), (2, 1, 6, 6, 2, 2)],
        "frame INT, pos INT, x INT, y INT, w INT, h INT",
    )
    frames = spark.createDataFrame([(1,), (2,), (3,)], "frame INT")
    got = {tuple(r) for r in aggregates.largest_box(boxes, "frame", "pos", frames).collect()}
    assert got == {(1, 1, 1, 2, 3), (2, 6, 6, 2, 2), (3, -1, -1, -1, -1)}
    df = spark.createDataFrame([(7, ["a", "b"], [0.1, 0.9])], "id INT, n ARRAY<STRING>, p ARRAY<DOUBLE>")
    rows = aggregates.rank_predictions(df, "n", "p", ["id"]).orderBy("rank").collect()
    assert [tuple(r) for r in rows] == [(7, 1, "b", 0.9), (7, 2, "a", 0.1)]
