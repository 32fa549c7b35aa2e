import os
from collections import Counter

from pyspark.sql import functions as F

from logloom.catalog import QUERIES
from logloom.operators import weblog
from logloom.operators.text import word_count
from logloom.sources.readers import stream_lines
from logloom.streaming import batches, pageviews, wordcount
from tests.test_weblog import line


def test_word_count_per_batch(spark, tmp_path):
    texts = ["a  b a\nx  \n", "a\n\n", " \nb b\n"]
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.txt").write_text(t)
    stream = stream_lines(spark, str(tmp_path), files_per_trigger=1)
    per_batch = wordcount.batch_word_counts(spark, stream)
    by_batch = {}
    for r in per_batch.collect():
        by_batch.setdefault(r.batch_id, {})[r.word] = r["count"]
    assert len(by_batch) == 3
    want = [{"a": 2, "": 1, "b": 1, "x": 1}, {"a": 1, "": 1}, {"b": 2}]
    assert sorted(map(sorted, (d.items() for d in by_batch.values()))) == sorted(
        map(sorted, (d.items() for d in want))
    )
    total = batches.sum_batches(per_batch, ["word"], "count")
    batch = word_count(spark.read.text(str(tmp_path)))
    assert {tuple(r) for r in total.collect()} == {tuple(r) for r in batch.collect()}


def test_running_word_count(spark, tmp_path):
    for i, t in enumerate(["a b\n", "a\n"]):
        (tmp_path / f"{i}.txt").write_text(t)
    stream = stream_lines(spark, str(tmp_path), files_per_trigger=1)
    counts = wordcount.running_word_counts(stream)
    query = (
        counts.writeStream.outputMode("complete").format("memory").queryName("running_words")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert {tuple(r) for r in spark.table("running_words").collect()} == {("a", 2), ("b", 1)}


def log_folder(tmp_path, n=60):
    lines = []
    for i in range(n):
        page = ["/a.html", "/b.js", "/c.html"][i % 3]
        time = f"07/Feb/2014:{i % 24:02d}:00:00 +0000"
        lines.append(line(f"10.0.0.{i % 4}", time, f"GET {page} HTTP/1.1", "A", f'"sid={i % 5}"'))
    lines[7] = "garbage"
    for i in range(3):
        file = tmp_path / f"{i}.log"
        file.write_text("\n".join(lines[i * n // 3 : (i + 1) * n // 3]) + "\n")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))  # the order of the batches
    return lines


def test_page_metrics(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    log_folder(folder)
    stream = stream_lines(spark, str(folder), files_per_trigger=2)
    tables = pageviews.page_metrics(spark, stream, str(tmp_path / "out"))
    pages = pageviews.parsed_pages(spark.read.text(str(folder)))
    views = batches.sum_batches(tables["page_views"], ["requested_resource"], "views")
    assert {tuple(r) for r in views.collect()} == {tuple(r) for r in weblog.page_views(pages).collect()}
    refs = batches.sum_batches(tables["referrals"], ["referer", "requested_resource"], "referrals")
    assert {tuple(r) for r in refs.collect()} == {tuple(r) for r in weblog.referral_counts(pages).collect()}
    seen = {r.session_id for r in tables["sessions"].collect()}
    assert seen == {r.session_id for r in weblog.session_ids(pages).collect()} and len(seen) == 5
    assert tables["page_views"].select("batch_id").distinct().count() == 2
    # a finished stream adds nothing when it is started again
    again = pageviews.page_metrics(spark, stream, str(tmp_path / "out"))
    assert again["page_views"].count() == tables["page_views"].count()


def test_windowed_views(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    log_folder(folder, n=72)
    pages = pageviews.parsed_pages(stream_lines(spark, str(folder)))

    def run(df, name):
        query = (
            df.writeStream.outputMode("append").format("memory").queryName(name)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.table(name)

    out = run(pageviews.windowed_page_views(pages, "1 hour", "1 hour"), "win_views")
    batch = pageviews.parsed_pages(spark.read.text(str(folder)))
    hours = batch.groupBy(F.window("ts", "1 hour").alias("w"), "requested_resource").count()
    want = {(r.w.start, r.requested_resource): r["count"] for r in hours.collect()}
    got = {(r.window.start, r.requested_resource): r.views for r in out.collect()}
    latest = max(s for s, _ in want)
    closed = {k: v for k, v in want.items() if (latest - k[0]).total_seconds() >= 7200}
    assert closed.items() <= got.items() and got.items() <= want.items()
    refs = run(pageviews.windowed_referrals(pages, "1 hour", "1 hour"), "win_refs")
    assert sum(r.referrals for r in refs.collect()) == sum(got.values())
    ids = [r.session_id for r in run(pageviews.windowed_sessions(pages, "2 days"), "win_ids").collect()]
    assert len(ids) == len(set(ids)) == 5


def test_counts_add_up(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y\ny\n")
    got = {r.word: r["count"] for r in word_count(spark.read.text(str(tmp_path))).collect()}
    assert got == Counter("x y y".split())


def test_printed_batches(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n")
    query = batches.print_batches(stream_lines(spark, str(tmp_path)), availableNow=True)
    query.awaitTermination()
    assert query.exception() is None


def test_table_streams_read_file_and_folder(spark, tmp_path):
    """The registered streams read a table that is one file and one that is several."""
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for name, parts in (("file", 1), ("folder", 3)):
        source.repartition(parts).write.parquet(str(tmp_path / name / "events.parquet"))
    want = {tuple(r) for r in QUERIES["page_views"](spark, "/root/testdata/sf0.001").collect()}
    for folder in ("/root/testdata/sf0.001", str(tmp_path / "file"), str(tmp_path / "folder")):
        got = QUERIES["stream_page_views"](spark, folder)
        assert {tuple(r) for r in got.collect()} == want


def test_no_input_gives_empty_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = stream_lines(spark, str(tmp_path / "in"))
    tables = pageviews.page_metrics(spark, stream, str(tmp_path / "out"), names=["page_views"])
    assert list(tables) == ["page_views"] and tables["page_views"].count() == 0
    assert tables["page_views"].columns == ["requested_resource", "views", "batch_id"]
