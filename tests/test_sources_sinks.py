import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from logloom import session
from logloom.functions.dates import iso_or_empty, parse_alert_date, parse_post_date
from logloom.functions.text import spaces_and_plus
from logloom.operators import aggregates, cleaning, joins
from logloom.sources import html, readers, sinks


def test_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    rows = readers.read_lines(spark, str(tmp_path)).collect()
    assert sorted(r.value for r in rows) == ["x", "y"] and rows[0].file.endswith("a.txt")


def test_labelled_tsv(spark, tmp_path):
    (tmp_path / "t.tsv").write_bytes(
        "﻿id\tstars\tbody\n1\tgood\thello\n9\tbad\tdropped\tcell\n2\t\tno label\n3\tfine\n".encode()
    )
    df = readers.read_labelled_tsv(
        spark, str(tmp_path / "t.tsv"), "id INT, stars STRING, body STRING", "stars", "body"
    )
    assert {tuple(r) for r in df.collect()} == {("good", "hello"), ("", "no label"), ("fine", "")}


def test_compressed_tsv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 24, "a\tb\nc"), (2, 30, "d")], "id INT, age INT, post STRING")
    out = str(tmp_path / "out")
    sinks.write_tsv(df, out, compress=True)
    back = readers.read_compressed_tsv(
        spark, out, "id INT, age INT, post STRING", ["id", "post"], F.col("age").isin(24, 25), 3
    )
    assert [tuple(r) for r in back.collect()] == [(1, "a b c")]
    assert back.rdd.getNumPartitions() == 3
    names = [p for p in (tmp_path / "out").iterdir() if p.name.endswith(".csv.gz")]
    assert any(gzip.open(p).readline() == b"id\tage\tpost\n" for p in names)


def test_photo_metadata(spark, tmp_path):
    cells = ["" for _ in range(17)]
    cells[6], cells[8], cells[10], cells[11] = "my+plane", "747,big+jet", "1.5", "oops"
    cells[13:16] = ["http://page", "http://h/i.jpg", "Attribution License"]
    (tmp_path / "p.tsv").write_text("\t".join(cells) + "\n")
    photos = readers.read_photo_metadata(spark, str(tmp_path / "p.tsv"))
    r = photos.first()
    assert (r.desc, r.latitude, r.longitude, r.ImageURL) == ("my+plane", 1.5, None, "http://h/i.jpg")
    flat = cleaning.tag_flags(cleaning.photo_columns(photos), ["747"]).first()
    assert flat.is_747 == 1 and flat.tags == "747,big jet"


def author_files(folder):
    posts = "<date>14,May,2004</date><post>\r\n\t first post </post><date>15,mai,2004</date><post>second\tone</post>"
    (folder / "101.female.24.Arts.Leo.xml").write_text(f"<Blog>{posts}<date>16,May,2004</date></Blog>")
    (folder / "102.male.25.indUnk.Aries.xml").write_text("<Blog></Blog>")
    (folder / "103.male.xx.Law.Virgo.xml").write_text("<Blog><date>1,May,2004</date><post>x</broken></Blog>")


def test_author_files(spark, tmp_path):
    author_files(tmp_path)
    authors = readers.read_author_files(spark, str(tmp_path / "*.xml")).cache()
    by_id = {r.blogger_id: r for r in authors.collect()}
    first = by_id[101]
    assert (first.gender, first.age, first.industry, first.astro_sign) == ("female", 24, "Arts", "Leo")
    assert by_id[103].age is None and by_id[103].corrupt
    assert tuple(readers.read_summary(authors).first()) == (3, 1)
    assert tuple(readers.read_summary(readers.read_author_files(spark, str(tmp_path / "*.xml"))).first()) == (3, 1)
    posts = readers.explode_posts(authors).withColumn("d", iso_or_empty(parse_post_date(F.col("date"))))
    got = [(r.blogger_id, r.post_no, r.d, r.post.strip()) for r in posts.orderBy("post_no").collect()]
    assert got == [(101, 0, "2004-05-14", "first post"), (101, 1, "2004-05-15", "second\tone")]
    lead = {r.blogger_id: r.first_post for r in readers.first_post(authors).collect()}
    assert lead[101].strip() == "first post" and lead[102] is None
    flat = readers.explode_posts(authors).select(spaces_and_plus("post").alias("p")).collect()
    assert "second one" in {r.p for r in flat}


def test_word_vectors(spark, tmp_path):
    (tmp_path / "v.txt").write_text("a 1 2\nb 3 4\na 5 6\nshort 1\nbad x y\n")
    got = {r.word: r.vec for r in readers.read_word_vectors(spark, str(tmp_path / "v.txt"), 2).collect()}
    assert got == {"a": [5.0, 6.0], "b": [3.0, 4.0]}


def test_edges_and_alerts(spark, tmp_path):
    (tmp_path / "1.csv").write_text("/a,/b\n")
    (tmp_path / "2.csv").write_text("/b, /c\n")
    edges = readers.read_edges(spark, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")])
    assert {tuple(r) for r in edges.collect()} == {("/a", "/b"), ("/b", "/c")}
    (tmp_path / "al.tsv").write_text(
        "Date\tCountry\tDistrict\tURL\n18-JUN-2014\tX\tKenema\thttp://u\n01-MAR-2014\tX\tBo http://u2\n"
    )
    alerts = readers.read_alerts(spark, str(tmp_path / "al.tsv"))
    assert alerts.where("URL is null").first().District == "Bo http://u2"
    latest = aggregates.latest_date(alerts.select(parse_alert_date(F.col("Date")).alias("d")), "d")
    assert latest.first().latest_date == "18 Jun 2014"
    (tmp_path / "ar.csv").write_text("CountryCode,Country,ADM_Level,FilePath\nXX,X,2,p.shp\n")
    areas = readers.read_areas(spark, str(tmp_path / "ar.csv"))
    names = spark.createDataFrame([("X", "West", "Kenemma", 1)], "Country STRING, ADM1 STRING, ADM2 STRING, ord INT")
    names = joins.inner_on(names, areas, "Country").withColumn(
        "name", joins.area_name(F.col("ADM_Level"), F.col("ADM1"), F.col("ADM2"))
    )
    hits = joins.fuzzy_join(alerts, names, "District", "name", "Country", "ord").collect()
    assert [(r.District, r.matched, r.distance) for r in hits] == [("Kenema", "Kenemma", 1)]


def test_inventory_and_work_list(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"x" * 2048)
    (tmp_path / "b.jpg").write_bytes(b"y")
    (tmp_path / "c.txt").write_bytes(b"z" * 4096)
    rows = readers.file_inventory(spark, str(tmp_path), "*.jpg", min_kb=1).collect()
    assert [(r.length, r.fingerprint) for r in rows] == [(2048, hashlib.md5(b"x" * 2048).hexdigest())]
    (tmp_path / "d.jpg").write_bytes(b"q" * 3000)
    (tmp_path / ".d.jpg.crc").write_bytes(b"crc\x00\x00\x00\x02\x00" + b"\x01" * 24)
    (tmp_path / "e.jpg").write_bytes(b"e" * 9000)
    rows = readers.file_inventory(spark, str(tmp_path), "*.jpg", min_kb=1, largest=8000).collect()
    assert {(r.path[-5:], r.length, r.fingerprint is None, r.state) for r in rows} == {
        ("a.jpg", 2048, False, "ok"), ("d.jpg", 3000, True, "unreadable"), ("e.jpg", 9000, True, "too large"),
    }
    (tmp_path / "w.tsv").write_text("ImageURL\tSize\tn\nu1\t\t1\nu2\t9 x 9\t2\nu1\t\t3\n")
    todo = readers.read_work_list(spark, str(tmp_path / "w.tsv"), "ImageURL STRING, Size STRING, n INT")
    assert [(r.ImageURL, r.n) for r in todo.collect()] == [("u1", 3)]


def test_cidr_files(spark, tmp_path):
    (tmp_path / "cidr-SG.txt").write_text("1.2.0.0/16\n\n8.8.8.0/24\n")
    rows = readers.read_cidr_blocks(spark, str(tmp_path / "cidr-SG.txt")).collect()
    assert {tuple(r) for r in rows} == {("SG", "1.2.0.0/16"), ("SG", "8.8.8.0/24")}


def test_html(spark):
    page = (
        '<nav><a href="/x">One</a><A class="k" href="http://o/y"><b>Two</b></A></nav>'
        '<img class="main-image" src="http://i/1.jpg"><section class="additional-info aircraft">'
        "<p>Aircraft: Airbus A320 </p><p>Airline: Test Air</p></section>"
        '<section class="additional-info photographer"><p> Jo Doe </p><p>more</p></section>'
    )
    df = spark.createDataFrame([("http://p", page)], "url STRING, html STRING")
    links = html.extract_links(df, prefix=F.lit("http://h")).collect()
    assert [(r.link_no, r.href, r.label) for r in links] == [
        (0, "http://h/x", "One"),
        (1, "http://o/y", "Two"),
    ]
    r = html.extract_photo_fields(df).first()
    assert (r.ImageURL, r.AircraftModel, r.Airline, r.Photographer, r.Permission) == (
        "http://i/1.jpg", "Airbus A320", "Test Air", "Jo Doe", "No",
    )
    alert = '<ul><li><a href="/csr/1">5 June 2014</a><span class="l">Ebola, update</span></li><li>x</li></ul>'
    df = spark.createDataFrame([(alert,)], "html STRING")
    assert [tuple(r) for r in html.extract_alerts(df, "http://w").collect()] == [
        ("5 June 2014", "http://w/csr/1", "Ebola, update")
    ]


def test_labels_and_text(spark, tmp_path):
    labels = spark.createDataFrame([("a", 0), ("b", 1)], "label STRING, idx INT")
    sinks.write_labels(labels, str(tmp_path / "l"))
    assert sorted(map(tuple, sinks.read_labels(spark, str(tmp_path / "l")).collect())) == [("a", 0), ("b", 1)]
    sinks.write_text(labels, str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a,0", "b,1"]


def test_accumulate(spark, tmp_path):
    old = spark.createDataFrame([("u", "old"), ("o", "old")], "k STRING, v STRING")
    sinks.write_table(old, str(tmp_path / "old"))
    new = spark.createDataFrame([("u", "new"), ("n", "new")], "k STRING, v STRING")
    merged = sinks.accumulate(new, str(tmp_path / "old"), ["k"], str(tmp_path / "next"))
    assert {tuple(r) for r in merged.collect()} == {("u", "old"), ("o", "old"), ("n", "new")}


def file_store(folder):
    """A stand-in for a database connection that appends statements to files."""

    class Store:
        def __init__(self):
            import os
            import uuid

            self.out = open(os.path.join(folder, uuid.uuid4().hex), "w")

        def cursor(self):
            return self

        def executemany(self, statement, rows):
            self.out.write(json.dumps([statement, list(rows)]) + "\n")

        def commit(self):
            self.out.flush()

        def close(self):
            self.out.close()

    return Store


def test_upsert(spark, tmp_path):
    recs = spark.createDataFrame(
        [(1, 1, 0.9), (1, 2, 0.5), (2, 1, 0.4), (2, 3, 0.3)], "base_id LONG, item_id LONG, relevance DOUBLE"
    ).repartition(2)
    sinks.upsert_recommendations(recs, file_store(str(tmp_path)), "UPSERT", batch=1)
    calls = [json.loads(x) for p in tmp_path.iterdir() for x in p.read_text().splitlines()]
    assert all(len(rows) == 1 and s == "UPSERT" for s, rows in calls)
    assert sorted(tuple(rows[0]) for _, rows in calls) == [(1, 2, 0.5), (2, 1, 0.4), (2, 3, 0.3)]


def test_kafka_options():
    options = readers.kafka_options("h:9092", "clicks")
    assert options["subscribe"] == "clicks" and options["kafka.bootstrap.servers"] == "h:9092"


def test_checkpoint_dir_comes_from_the_session(spark):
    folder = session.checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert folder and (named is None or folder == named)
    df = session.cut_lineage(spark.range(10))
    assert df.count() == 10
    assert session.work_dir(spark, "x").startswith(folder)


def test_streams_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://cluster"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
