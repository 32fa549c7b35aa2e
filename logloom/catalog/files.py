"""Files written from the tables and read back through the scans of the library."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.catalog.base import Tables, query
from logloom.catalog.items import preferences
from logloom.catalog.logs import readings
from logloom.functions.dates import iso_or_empty, parse_alert_date, parse_post_date
from logloom.operators import aggregates, cleaning, graph, text, timeseries
from logloom.session import work_dir
from logloom.sources import readers, sinks


def _fresh(t: Tables, name: str) -> str:
    return work_dir(t.spark, name)


@query(
    "sensor_csv",
    """
    SELECT CASE WHEN event_id % 97 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS date,
           CASE WHEN event_id % 97 = 0 THEN -1 ELSE hour(ts) END AS hour,
           CAST(user_id AS VARCHAR) AS id,
           CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS total
    FROM events WHERE event_id % 89 <> 0
    GROUP BY 1, 2, 3
    """,
)
def sensor_csv(t: Tables) -> DataFrame:
    path = _fresh(t, "sensors")
    padded = readings(t).withColumn("SensorID", F.concat(F.lit("  "), "SensorID", F.lit(" ")))
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    padded.write.csv(path, header=True, **keep)
    rows = readers.read_sensor_csv(t.spark, path)
    return timeseries.hourly_totals(rows, "Timestamp", "SensorID", "Reading")


@query(
    "repeated_headers",
    """
    SELECT 'S' || user_id % 50 AS sensor, count(*) AS readings, count(*) FILTER (event_id % 11 = 0) AS without_time
    FROM events GROUP BY 1
    """,
)
def repeated_headers(t: Tables) -> DataFrame:
    """Files glued together: the header is met again in the middle, with blanks around it."""
    path = _fresh(t, "glued")
    time = F.when(F.col("event_id") % 11 == 0, "").otherwise(F.date_format("ts", "M/d/yyyy H:mm:ss"))
    line = F.concat(time, F.lit(", S"), (F.col("user_id") % 50).cast("string"), F.lit(" ,"), F.col("value").cast("string"))
    lines = F.when(F.col("event_id") % 40 == 0, F.array(F.lit("Timestamp, SensorID , Reading"), line)).otherwise(F.array(line))
    # every file begins with the header of its own
    rows = t.events.select(F.explode(lines).alias("value"))
    titled = rows.mapInPandas(_with_header, "value STRING")
    titled.write.text(path)
    readings_read = readers.read_sensor_csv(t.spark, path)
    return readings_read.groupBy(F.col("SensorID").alias("sensor")).agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col("Timestamp").isNull() | (F.col("Timestamp") == "")).alias("without_time")
    )


def _with_header(batches):
    header = pd.DataFrame({"value": ["Timestamp,SensorID,Reading"]})
    yield header
    yield from batches


@query(
    "line_word_count",
    r"""
    WITH lines AS (
      SELECT unnest(string_split(text, chr(10))) AS value FROM documents
    ), cut AS (
      SELECT CASE WHEN length(value) = 0 THEN [''] WHEN length(rtrim(value, ' ')) = 0 THEN []
        ELSE string_split(rtrim(value, ' '), ' ') END AS l FROM lines
    )
    SELECT word, count(*) AS n FROM (SELECT unnest(l) AS word FROM cut) GROUP BY word
    """,
)
def line_word_count(t: Tables) -> DataFrame:
    path = _fresh(t, "lines")
    t.spread("documents").select("text").write.text(path)
    return text.word_count(readers.read_lines(t.spark, path)).withColumnRenamed("count", "n")


@query(
    "labelled_tsv",
    """
    SELECT coalesce(CAST(quality AS VARCHAR), '') AS label, md5(translate(text, chr(10) || chr(9), '  ')) AS text
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def labelled_tsv(t: Tables) -> DataFrame:
    path = _fresh(t, "labelled")
    rows = t.spread("documents").select("doc_id", "text").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    sinks.write_tsv(rows, path)
    schema = "doc_id BIGINT, body STRING, mark STRING"
    back = readers.read_labelled_tsv(t.spark, path, schema, "mark", "body")
    return back.select("label", F.md5(F.col("text").cast("binary")).alias("text"))


@query(
    "compressed_tsv",
    """
    SELECT doc_id, md5(translate(text, chr(10) || chr(9), '  ')) AS text FROM documents WHERE lang IN ('en', 'fr')
    """,
)
def compressed_tsv(t: Tables) -> DataFrame:
    path = _fresh(t, "posts")
    sinks.write_tsv(t.spread("documents").select("doc_id", "lang", "text"), path, compress=True)
    schema = "doc_id BIGINT, lang STRING, text STRING"
    rows = readers.read_compressed_tsv(
        t.spark, path, schema, ["doc_id", "text"], F.col("lang").isin("en", "fr")
    )
    return rows.withColumn("text", F.md5(F.col("text").cast("binary")))


LICENSES = "Attribution-NonCommercial-NoDerivs License"


@query(
    "photo_table",
    """
    WITH photos AS (
      SELECT p_partkey, p_name AS d, p_name || ',' || p_type AS tags, 'http://img.example/' || p_partkey || '_b.jpg' AS url
      FROM part WHERE p_partkey % 3 <> 0
    )
    SELECT d AS desc, tags, url AS ImageURL, md5(url) || '.jpg' AS image_file_name, 2::INT AS num_tags,
      CAST(p_partkey AS DOUBLE) AS latitude,
      CAST(list_contains(string_split(tags, ','), 'ECONOMY') AS INT) AS is_ECONOMY,
      CAST(list_contains(string_split(tags, ','), 'ring') AS INT) AS is_ring
    FROM photos
    """,
)
def photo_table(t: Tables) -> DataFrame:
    path = _fresh(t, "photos")
    key = F.col("p_partkey").cast("string")
    cells = {i: F.lit("-") for i in range(17)}
    cells[6] = F.replace(F.col("p_name"), F.lit(" "), F.lit("+"))
    cells[8] = F.concat(cells[6], F.lit(","), "p_type")
    cells[10] = key
    cells[11] = F.lit("east")
    cells[13] = F.concat(F.lit("http://page.example/"), key)
    cells[14] = F.concat(F.lit("http://img.example/"), key, F.lit(".jpg"))
    cells[15] = F.when(F.col("p_partkey") % 3 == 0, "Other License").otherwise(LICENSES)
    wide = t.part.select(*[c.alias(f"c{i}") for i, c in sorted(cells.items())])
    sinks.write_text(wide, path, sep="\t")
    photos = cleaning.photo_columns(readers.read_photo_metadata(t.spark, path))
    flagged = cleaning.tag_flags(cleaning.with_license(photos, LICENSES), ["ECONOMY", "ring"])
    columns = ["desc", "tags", "ImageURL", "image_file_name", "num_tags", "latitude"]
    return flagged.select(*columns, "is_ECONOMY", "is_ring")


@query(
    "word_vector_file",
    """
    SELECT 'w' || vec_id AS word, round(CAST(embedding[1] AS DOUBLE), 6) AS first,
      round(CAST(embedding[64] AS DOUBLE), 6) AS last FROM embeddings
    """,
)
def word_vector_file(t: Tables) -> DataFrame:
    path = _fresh(t, "vectors")
    word = F.concat(F.lit("w"), F.col("vec_id").cast("string"))
    values = F.array_join(F.col("embedding").cast("array<string>"), " ")
    lines = F.concat_ws(" ", word, values)
    # lines of a wrong width are skipped
    short = F.concat(F.lit("x"), F.col("vec_id").cast("string"), F.lit(" 0.5"))
    t.embeddings.select(F.explode(F.array(lines, short))).write.text(path)
    vectors = readers.read_word_vectors(t.spark, path, 64)
    return vectors.select(
        "word",
        F.round(F.col("vec")[0].cast("double"), 6).alias("first"),
        F.round(F.col("vec")[63].cast("double"), 6).alias("last"),
    )


@query(
    "edge_files",
    """
    SELECT page FROM (SELECT '/c' || o_custkey AS page FROM orders UNION SELECT '/p' || o_orderpriority FROM orders)
    """,
)
def edge_files(t: Tables) -> DataFrame:
    paths = [_fresh(t, "edges"), _fresh(t, "edges")]
    edges = t.orders.select(
        F.concat(F.lit("/c"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("/p"), "o_orderpriority").alias("dst"),
        "o_orderstatus",
    )
    for path, part in zip(paths, ("o_orderstatus = 'F'", "o_orderstatus <> 'F'")):
        sinks.write_text(edges.where(part).select("src", "dst"), path)
    nodes, _ = graph.build_graph(readers.read_edges(t.spark, paths))
    return nodes


@query(
    "preference_file",
    """
    SELECT o_custkey AS base_id, count(DISTINCT l_suppkey) AS items
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """,
)
def preference_file(t: Tables) -> DataFrame:
    path = _fresh(t, "preferences")
    sinks.write_text(preferences(t, "l_suppkey").withColumn("pref", F.lit(1)), path)
    rows = readers.read_preferences(t.spark, path)
    return rows.groupBy("base_id").agg(F.count_distinct("item_id").alias("items"))


@query(
    "label_json",
    """
    SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INT) AS idx
    FROM (SELECT DISTINCT source FROM documents)
    """,
)
def label_json(t: Tables) -> DataFrame:
    from logloom.operators.features import label_index

    path = _fresh(t, "labels")
    sinks.write_labels(label_index(t.documents, "source"), path)
    return sinks.read_labels(t.spark, path)


@query(
    "alert_file",
    """
    SELECT 'NATION_' || (o_custkey % 25) AS country, strftime(max(o_orderdate), '%d %b %Y') AS latest,
      count(*) AS alerts FROM orders GROUP BY 1
    """,
)
def alert_file(t: Tables) -> DataFrame:
    path = _fresh(t, "alerts")
    country = F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string"))
    rows = t.orders.select(
        F.upper(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("Date"),
        country.alias("Country"),
        F.col("o_orderpriority").alias("District"),
        F.concat(F.lit("http://a.example/"), F.col("o_orderkey").cast("string")).alias("URL"),
    )
    sinks.write_tsv(rows, path)
    alerts = readers.read_alerts(t.spark, path).withColumn("day", parse_alert_date(F.col("Date")))
    return alerts.groupBy(F.col("Country").alias("country")).agg(
        F.date_format(F.max("day"), "dd MMM yyyy").alias("latest"), F.count(F.lit(1)).alias("alerts")
    )


@query(
    "work_list_file",
    """
    SELECT 'http://i.example/' || o_custkey AS ImageURL, max(o_orderkey) AS n FROM orders
    WHERE o_orderstatus <> 'F' GROUP BY 1
    """,
)
def work_list_file(t: Tables) -> DataFrame:
    path = _fresh(t, "work")
    rows = t.orders.select(
        F.concat(F.lit("http://i.example/"), F.col("o_custkey").cast("string")).alias("ImageURL"),
        F.when(F.col("o_orderstatus") == "F", "1024 x 683").alias("Size"),
        F.col("o_orderkey").alias("n"),
    )
    # the last line per URL counts, so the list is written in order
    sinks.write_tsv(rows.orderBy("n"), path)
    schema = "ImageURL STRING, Size STRING, n BIGINT"
    return readers.read_work_list(t.spark, path, schema).select("ImageURL", "n")


@query(
    "accumulate_files",
    """
    SELECT o_custkey, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_orderkey DESC) AS r
      FROM (SELECT o_custkey, o_orderstatus = 'F' AS f, any_value(o_orderstatus) AS o_orderstatus,
              max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey, f)) WHERE r = 1
    """,
)
def accumulate_files(t: Tables) -> DataFrame:
    latest = t.orders.groupBy("o_custkey", (F.col("o_orderstatus") == "F").alias("old")).agg(
        F.max("o_orderkey").alias("o_orderkey")
    )
    path = _fresh(t, "previous")
    sinks.write_table(latest.where("old").drop("old"), path)
    new = latest.where("NOT old").drop("old")
    return sinks.accumulate(new, path, ["o_custkey"], _fresh(t, "merged"), prefer="old")


# --- author files: attributes in the name, posts in the body ---


@query(
    "author_attributes",
    """
    SELECT c_custkey AS blogger_id, CASE c_custkey % 2 WHEN 0 THEN 'female' ELSE 'male' END AS gender,
      CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(20 + c_nationkey AS INT) END AS age,
      c_mktsegment AS industry, 'Leo' AS astro_sign
    FROM customer
    """,
)
def author_attributes(t: Tables) -> DataFrame:
    gender = F.when(F.col("c_custkey") % 2 == 0, "female").otherwise("male")
    age = F.when(F.col("c_custkey") % 10 == 0, "unknown").otherwise(
        (20 + F.col("c_nationkey")).cast("string")
    )
    name = F.concat_ws(".", F.col("c_custkey").cast("string"), gender, age, "c_mktsegment", F.lit("Leo"), F.lit("xml"))
    files = t.customer.select(F.concat(F.lit("file:/blogs/"), name).alias("file"))
    return readers.with_filename_attributes(files).drop("file")


def _xml(column: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        column = F.replace(column, F.lit(raw), F.lit(safe))
    return column


def _blogs(t: Tables) -> DataFrame:
    # one <Blog> per conversation; every third one has a date without a post
    day = F.concat(((F.col("turn") % 28) + 1).cast("string"), F.lit(",May,2004"))
    post = F.concat(F.lit("<date>"), day, F.lit("</date><post>"), _xml(F.col("text")), F.lit("</post>"))
    turns = t.spread("conversations").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.replace(post, F.lit("\n"), F.lit(" ")).alias("x")))).alias("l")
    )
    extra = F.when(F.col("conv_id") % 3 == 0, "<date>1,June,2004</date>").otherwise("")
    body = F.array_join(F.transform("l", lambda s: s["x"]), "")
    return turns.select("conv_id", F.concat(F.lit("<Blog>"), body, extra, F.lit("</Blog>")).alias("value"))


@query(
    "author_files",
    """
    SELECT count(DISTINCT c_custkey // 50) AS files, count(DISTINCT CASE WHEN c_custkey // 50 % 9 = 0 THEN c_custkey // 50 END) AS failed,
      count(*) FILTER (c_custkey // 50 % 9 <> 0) AS posts
    FROM customer
    """,
)
def author_files(t: Tables) -> DataFrame:
    """Author files read from a folder: how many, how many of them broken, and the posts of the others."""
    path = _fresh(t, "blogs")
    part = F.floor(F.col("c_custkey") / 50)
    post = F.concat(F.lit("<date>1,May,2004</date><post>"), _xml(F.col("c_name")), F.lit("</post>"))
    bodies = t.customer.groupBy(part.alias("part")).agg(F.array_join(F.collect_list(post), "\n").alias("posts"))
    # a broken file: its last element is not closed
    tail = F.when(F.col("part") % 9 == 0, "<post>cut</Blog>").otherwise("</Blog>")
    blogs = bodies.select("part", F.concat(F.lit("<Blog>"), "posts", tail).alias("value"))
    blogs.repartition("part").write.partitionBy("part").text(path)
    authors = readers.read_author_files(t.spark, path)
    posts = readers.explode_posts(authors.where(~F.col("corrupt"))).agg(F.count(F.lit(1)).alias("posts"))
    # one row each
    return readers.read_summary(authors).crossJoin(posts)


@query(
    "author_posts",
    r"""
    SELECT conv_id, '2004-05-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') AS date,
      CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, replace(text, chr(10), ' ')) - 1 AS INT) AS post_no,
      md5(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g')) AS post FROM conversations
    """,
)
def author_posts(t: Tables) -> DataFrame:
    posts = readers.explode_posts(readers.parse_blogs(_blogs(t), "value"))
    tidy = F.regexp_replace(F.regexp_replace("post", r"\s+", " "), "^ | $", "")
    return posts.select(
        "conv_id",
        iso_or_empty(parse_post_date(F.col("date"))).alias("date"),
        "post_no",
        F.md5(tidy.cast("binary")).alias("post"),
    )


@query(
    "first_posts",
    r"""
    SELECT conv_id, md5(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g')) AS post FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, replace(text, chr(10), ' ')) AS r FROM conversations)
    WHERE r = 1
    """,
)
def first_posts(t: Tables) -> DataFrame:
    first = readers.first_post(readers.parse_blogs(_blogs(t), "value"))
    tidy = F.regexp_replace(F.regexp_replace("first_post", r"\s+", " "), "^ | $", "")
    return first.select("conv_id", F.md5(tidy.cast("binary")).alias("post"))


@query("file_inventory")
def file_inventory(t: Tables) -> DataFrame:
    """Length and fingerprint of every file of the table folder."""
    return readers.file_inventory(t.spark, t.folder, "*.parquet")


def _page_folders(t: Tables) -> str:
    # one file per hundred pages, its lines in the order of page_id
    path = _fresh(t, "pages")
    rows = t.pages.select("page_id", F.floor(F.col("page_id") / 100).alias("part"), F.concat_ws("", "html").alias("value"))
    ordered = rows.repartition("part").sortWithinPartitions("part", "page_id").select("part", "value")
    ordered.write.partitionBy("part").text(path)
    return path


PAGE_FILES_SQL = """
WITH files AS (
  SELECT page_id // 100 AS part, string_agg(coalesce(html, '') || chr(10), '' ORDER BY page_id) AS body FROM pages GROUP BY 1
)
"""


@query(
    "page_file_inventory",
    PAGE_FILES_SQL + "SELECT part, CAST(strlen(body) AS BIGINT) AS length, md5(body) AS fingerprint, 'ok' AS state FROM files",
)
def page_file_inventory(t: Tables) -> DataFrame:
    """Length and fingerprint of files written from the pages."""
    files = readers.file_inventory(t.spark, _page_folders(t), "*.txt")
    part = F.regexp_extract("path", r"part=(\d+)", 1).cast("bigint")
    return files.select(part.alias("part"), "length", "fingerprint", "state")


@query(
    "least_file_size",
    PAGE_FILES_SQL + "SELECT part, CAST(strlen(body) AS BIGINT) AS length FROM files WHERE strlen(body) >= 64 * 1024",
)
def least_file_size(t: Tables) -> DataFrame:
    """Files of 64 KB and more; no content is read."""
    files = cleaning.min_size(readers.file_inventory(t.spark, _page_folders(t), "*.txt"), 64)
    return files.select(F.regexp_extract("path", r"part=(\d+)", 1).cast("bigint").alias("part"), "length")


@query(
    "table_to_text",
    "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1",
)
def table_to_text(t: Tables) -> DataFrame:
    path = _fresh(t, "totals")
    sinks.write_text(aggregates.class_counts(t.customer, "c_mktsegment"), path)
    return t.spark.read.csv(path, schema="c_mktsegment STRING, n BIGINT")
