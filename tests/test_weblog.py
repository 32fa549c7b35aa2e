from pyspark.sql import functions as F

from logloom.operators import timeseries, weblog
from logloom.operators.aggregates import error_counts
from logloom.plans.segments import number_rows, refine
from logloom.sources import readers

AGENTS = ["Mobile (A; B)", "Windows (C)"]


def line(ip, time, request, agent, session='"sid=1"', referer="http://site/", status=200, size="10"):
    return f'{ip} - - [{time}] "{request}" {status} {size} "{referer}" "{agent}" {session}'


def log_lines():
    # two visitors, two pages each, two sessions
    rows = []
    for n, (ip, agent, sid) in enumerate(
        [("10.0.0.227", AGENTS[0], '"sid=a"'), ("10.0.0.228", AGENTS[1], '"sid=b"')]
    ):
        for page in (1 + n, 3 + n):
            time = f"07/Feb/2014:17:59:0{page} +0000"
            uri = f"/category-{n + 1}/page-{page}.html"
            rows.append(line(ip, time, f"GET {uri} HTTP/1.1", agent, sid))
    return rows


def parsed(spark, lines, **kw):
    df = spark.createDataFrame(list(enumerate(lines)), "seq LONG, value STRING")
    return weblog.parse_access_log(df, session=True, **kw)


def test_metrics_of_sample(spark):
    pages = weblog.pages_only(parsed(spark, log_lines()))
    views = {r.requested_resource: r.views for r in weblog.page_views(pages).collect()}
    assert len(views) == 4 and set(views.values()) == {1}
    refs = weblog.referral_counts(pages).collect()
    assert {(r.referer, r.referrals) for r in refs} == {("http://site/", 1)} and len(refs) == 4
    raw = {r.session_id for r in weblog.session_ids(pages).collect()}
    assert raw == {'"sid=a"', '"sid=b"'}
    clean = {r.session_id for r in weblog.session_ids(pages, "session_id").collect()}
    assert clean == {"sid=a", "sid=b"}


def test_page_sequences(spark):
    log = weblog.with_visitor(weblog.pages_only(parsed(spark, log_lines())))
    got = {(r.visitor, r.part): r.pages for r in weblog.page_sequences(log).collect()}
    assert got == {
        ("10.0.0.227_" + AGENTS[0], 0): ["/category-1/page-1.html", "/category-1/page-3.html"],
        ("10.0.0.228_" + AGENTS[1], 0): ["/category-2/page-2.html", "/category-2/page-4.html"],
    }


def test_rejects_and_typed_cells(spark):
    lines = [
        line("10.0.0.1", "07/Feb/2014:17:59:07 +0800", "GET / HTTP/1.1", "A", '"-"'),
        "",
        "garbage",
        line("", "bad", "GET /x.png HTTP/1.1", "A", "-", "-", 404, "-"),
        line("10.0.0.1", "07/Feb/2014:17:59:08 +0000", "GET /a.js HTTP/1.1", "A"),
        None,
        line("10.0.0.2", "07/Feb/2014:17:59:09 +0000", "GET /m.html HTTP/1.1", "odd\x01agent"),
        "prefix " + line("10.0.0.3", "07/Feb/2014:17:59:09 +0000", "GET /n HTTP/1.1", "A$1") + " x\ny",
        "\x01" * 9,
    ]
    rows = parsed(spark, lines).orderBy("seq").collect()
    assert [r.matched for r in rows] == [True, False, False, True, True, False, True, True, False]
    assert (rows[6].user_agent, rows[6].requested_resource) == ("odd\x01agent", "/m.html")
    assert (rows[7].ip, rows[7].user_agent) == ("10.0.0.3", "A$1")
    first = rows[0]
    assert first.requested_resource == "/1.1" and first.status == 200 and first.bytes == 10
    assert str(first.ts) and first.session_raw == '"-"' and first.session_id is None
    assert rows[1].requested_resource is None and rows[1].ip is None
    odd = rows[3]
    assert odd.ip is None and odd.ts is None and odd.bytes is None and odd.status == 404
    strict = parsed(spark, lines, strict=True).orderBy("seq").first()
    assert strict.requested_resource == "/"
    kept = weblog.pages_only(parsed(spark, lines))
    assert {r.seq for r in kept.collect()} == {0, 3, 6, 7}
    counts = error_counts(parsed(spark, lines), ~F.col("matched")).first()
    assert (counts["read"], counts.failed) == (9, 4)


def test_missing_ip_visitor(spark):
    df = spark.createDataFrame([(None, "A")], "ip STRING, user_agent STRING")
    assert weblog.with_visitor(df).first().visitor == "_A"
    assert weblog.with_visitor(df, parity=True).first().visitor == "null_A"


def visits(spark):
    rows = []
    for i in range(200):
        user = "hot" if i % 3 else f"u{i % 7}"
        ts = None if i % 11 == 0 else f"2024-01-01 {(i * 7) % 24:02d}:{i % 60:02d}:00"
        rows.append((user, ts, i, f"/p{i}"))
    df = spark.createDataFrame(rows, "visitor STRING, ts STRING, seq LONG, requested_resource STRING")
    return df.withColumn("ts", F.to_timestamp("ts"))


def brute(df):
    users = {}
    for r in df.collect():
        users.setdefault(r.visitor, []).append(r)
    for rows in users.values():
        rows.sort(key=lambda r: (r.ts is not None, r.ts, r.seq) if r.ts else (False, 0, r.seq))
    return users


def test_long_visits_are_cut_and_whole(spark):
    df = visits(spark)
    got = {}
    parts = weblog.page_sequences(df, max_pages=10).orderBy("visitor", "part").collect()
    for r in parts:
        got.setdefault(r.visitor, []).extend(r.pages)
    assert len([r for r in parts if r.visitor == "hot"]) > 3
    assert got == {u: [r.requested_resource for r in rows] for u, rows in brute(df).items()}


def test_previous_page(spark):
    df = visits(spark)
    got = {r.seq: r.previous_page for r in weblog.with_previous_page(df).collect()}
    want = {}
    for rows in brute(df).values():
        for before, r in zip([None, *rows], rows):
            want[r.seq] = before.requested_resource if before else "-"
    assert got == want


def test_events_in_time_order(spark):
    df = visits(spark).where("ts is not null")
    got = [r.seq for r in weblog.in_time_order(df, "ts", "seq").collect()]
    assert got == [r.seq for r in sorted(df.collect(), key=lambda r: (r.ts, r.seq))]


def test_hourly_totals_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Timestamp,SensorID,Reading\n"
        "2014-09-28T00:02:25, 431 ,341\n"
        "2014-09-28T00:59:59,431,2147483647\n"
        "Timestamp,SensorID,Reading\n"
        "2014-09-28T01:00:00,431,5\n"
        "bad,431,7\n"
        "2014-09-28T25:00:00,431,1\n"
        "2014-09-28T02:00:00,431,oops\n"
    )
    df = readers.read_sensor_csv(spark, str(tmp_path / "a.csv"))
    rows = timeseries.hourly_totals(df, "Timestamp", "SensorID", "Reading").collect()
    assert {tuple(r) for r in rows} == {
        ("2014-09-28", 0, "431", 2147483988),
        ("2014-09-28", 1, "431", 5),
        ("", -1, "431", 8),
    }
    assert tuple(timeseries.rejects(df, "Reading").first()) == (6, 1)


def test_one_crowded_hour_is_cut_at_seconds(spark):
    """A visitor with every request in one hour is handled in many segments, with the same result."""
    rows = spark.range(600).select(
        F.lit("bot").alias("visitor"),
        F.timestamp_seconds(1_391_731_200 + (F.col("id") * 7) % 300).alias("ts"),
        F.col("id").alias("seq"),
        F.concat(F.lit("/"), F.col("id") % 11).alias("requested_resource"),
    )
    want = [r.requested_resource for r in rows.orderBy("ts", "seq").collect()]
    parts = weblog.page_sequences(rows, max_pages=50, crowded=100).orderBy("part").collect()
    assert len(parts) > 8 and [p for r in parts for p in r.pages] == want
    linked = weblog.with_previous_page(rows, crowded=100)
    plain = weblog.with_previous_page(rows)
    assert linked.columns == plain.columns
    assert sorted(map(tuple, linked.collect())) == sorted(map(tuple, plain.collect()))
    cut = refine(rows, ["visitor"], [F.date_trunc("hour", "ts")], F.minute("ts") * 60 + F.second("ts"), "second", 100)
    assert cut.groupBy("second").count().agg(F.max("count")).first()[0] == 2


def test_numbers_over_a_whole_table(spark):
    """Null buckets first, one bucket with a third of the rows, more buckets than partitions."""
    score = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 97 != 0, (F.col("id") * 31) % 200)
    rows = spark.range(3000).select("id", score.alias("score")).repartition(5)
    got = number_rows(rows, [], [F.col("score")], [F.col("score").asc_nulls_first(), F.col("id")]).collect()
    plain = sorted(got, key=lambda r: (r.score is not None, r.score or 0, r.id))
    assert [r.pos for r in plain] == list(range(1, 3001))
    assert number_rows(rows.where("false"), [], [F.col("score")], [F.col("score"), F.col("id")]).count() == 0
