"""Cleaning, de-duplication, joins and rankings on the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.catalog.base import Tables, query
from logloom.operators import aggregates, cleaning, graph, joins, models
from logloom.sources import html


def day(column: str):
    return F.date_format(column, "yyyy-MM-dd")


@query(
    "class_counts",
    "SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality",
)
def class_counts(t: Tables) -> DataFrame:
    return aggregates.class_counts(t.labels, "quality")


@query("latest_date", "SELECT strftime(max(o_orderdate), '%d %b %Y') AS latest_date FROM orders")
def latest_date(t: Tables) -> DataFrame:
    return aggregates.latest_date(t.orders, "o_orderdate")


@query("distinct_values", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_values(t: Tables) -> DataFrame:
    return aggregates.distinct_values(t.orders, "o_orderpriority", "o_orderstatus")


@query(
    "score_summary",
    """
    SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, max(value) AS best
    FROM events GROUP BY event_type
    """,
)
def score_summary(t: Tables) -> DataFrame:
    s = aggregates.score_summary(t.events, ["event_type"], "value")
    return s.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("table_size", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def table_size(t: Tables) -> DataFrame:
    return aggregates.size_of(t.lineitem)


FIRST_LAST = """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate {d}, o_orderkey {d}) AS r
  FROM orders) WHERE r = 1
"""


def _kept(t: Tables, keep: str) -> DataFrame:
    slim = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    rows = cleaning.dedup_keep(slim, ["o_custkey"], ["o_orderdate", "o_orderkey"], keep)
    return rows.withColumn("o_orderdate", day("o_orderdate"))


@query("dedup_keep_first", FIRST_LAST.format(d="ASC"))
def dedup_keep_first(t: Tables) -> DataFrame:
    return _kept(t, "first")


@query("dedup_keep_last", FIRST_LAST.format(d="DESC"))
def dedup_keep_last(t: Tables) -> DataFrame:
    return _kept(t, "last")


def _runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    slim = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return slim.where("o_orderstatus <> 'F'"), slim.where("o_orderstatus = 'F'")


MERGE_SQL = """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (
    PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') {d}, o_orderkey DESC) AS r
  FROM orders) WHERE r = 1
"""


@query("merge_prefer_old", MERGE_SQL.format(d="DESC"))
def merge_prefer_old(t: Tables) -> DataFrame:
    new, old = _runs(t)
    return cleaning.merge_previous(new, old, ["o_custkey"], "old", ["o_orderkey"])


@query("merge_prefer_new", MERGE_SQL.format(d="ASC"))
def merge_prefer_new(t: Tables) -> DataFrame:
    new, old = _runs(t)
    return cleaning.merge_previous(new, old, ["o_custkey"], "new", ["o_orderkey"])


@query(
    "union_of_frames",
    """
    SELECT origin, count(*) AS n, count(c_acctbal) AS n_bal, count(s_acctbal) AS n_sbal FROM (
      SELECT 'customer' AS origin, c_acctbal, NULL AS s_acctbal FROM customer
      UNION ALL SELECT 'supplier', NULL, s_acctbal FROM supplier) GROUP BY origin
    """,
)
def union_of_frames(t: Tables) -> DataFrame:
    a = t.customer.select(F.lit("customer").alias("origin"), "c_acctbal")
    b = t.supplier.select(F.lit("supplier").alias("origin"), "s_acctbal")
    return (
        cleaning.union_all(a, b)
        .groupBy("origin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("c_acctbal").alias("n_bal"),
            F.count("s_acctbal").alias("n_sbal"),
        )
    )


@query(
    "filter_recode",
    """
    SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 2 WHEN 'MACHINERY' THEN 1 END AS segment,
           c_acctbal AS balance
    FROM customer WHERE c_nationkey IN (3, 4, 5) AND c_acctbal IS NOT NULL
    """,
)
def filter_recode(t: Tables) -> DataFrame:
    rows = cleaning.rows_in(cleaning.complete_rows(t.customer, ["c_acctbal"]), "c_nationkey", [3, 4, 5])
    coded = cleaning.recode(rows, "c_mktsegment", {"BUILDING": 2, "MACHINERY": 1})
    names = {"c_custkey": "id", "c_mktsegment": "segment", "c_acctbal": "balance"}
    return cleaning.shaped(coded, ["id", "segment", "balance"], names)


@query(
    "fill_and_null_filter",
    """
    SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.doc_id IS NULL AS unlabelled
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def fill_and_null_filter(t: Tables) -> DataFrame:
    joined = joins.attach(t.documents.select("doc_id"), t.labels.select("doc_id", "quality"), "doc_id")
    marked = cleaning.union_all(
        cleaning.without_value(joined, "quality").withColumn("unlabelled", F.lit(True)),
        cleaning.complete_rows(joined, ["quality"]).withColumn("unlabelled", F.lit(False)),
    )
    return cleaning.filled(marked, {"quality": -1})


# --- joins ---


@query(
    "inner_join",
    """
    SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def inner_join(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return joins.inner_on(orders, people, "c_custkey").drop("c_custkey")


@query("semi_join", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_join(t: Tables) -> DataFrame:
    return joins.keep_listed(t.documents.select("doc_id", "source"), t.labels, "doc_id")


@query(
    "anti_join",
    "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def anti_join(t: Tables) -> DataFrame:
    toxic = t.labels.where("toxic = 1")
    return joins.exclude_listed(t.documents.select("doc_id", "source"), toxic, "doc_id")


@query(
    "left_join",
    """
    SELECT c_custkey, c_name, n_orders FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON c_custkey = o_custkey
    """,
)
def left_join(t: Tables) -> DataFrame:
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
    computed = counts.agg(F.count(F.lit(1)).alias("n_orders"))
    return joins.attach(t.customer.select("c_custkey", "c_name"), computed, "c_custkey")


def _stores(t: Tables) -> list[DataFrame]:
    return [t.labels.select("doc_id"), t.embeddings.select(F.col("vec_id").alias("doc_id"))]


STORE_SQL = """
SELECT doc_id FROM documents WHERE doc_id {op} (SELECT doc_id FROM labels UNION SELECT vec_id FROM embeddings)
"""


@query("missing_from_stores", STORE_SQL.format(op="NOT IN"))
def missing_from_stores(t: Tables) -> DataFrame:
    return joins.missing_from(t.documents.select("doc_id"), _stores(t), "doc_id")


@query("present_in_stores", STORE_SQL.format(op="IN"))
def present_in_stores(t: Tables) -> DataFrame:
    return joins.present_in(t.documents.select("doc_id"), _stores(t), "doc_id")


@query(
    "lookup_first",
    """
    SELECT c_custkey, o_orderpriority, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders)
    JOIN customer ON c_custkey = o_custkey WHERE r = 1
    """,
)
def lookup_first(t: Tables) -> DataFrame:
    table = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return joins.lookup_first(
        t.customer.select("c_custkey"), table, "c_custkey", ["o_orderkey"], ["o_orderpriority", "o_totalprice"]
    )


def _misspelt(t: Tables) -> tuple[DataFrame, DataFrame]:
    label = F.concat_ws(" ", "p_name", "p_type")
    n = F.length(label)
    at = (F.col("p_partkey") % n + 1).cast("int")
    cut = F.concat(F.substr(label, F.lit(1), at - 1), F.substr(label, at + 1, n))
    grown = F.concat(F.substr(label, F.lit(1), at), F.lit("xyz"), F.substr(label, at + 1, n))
    again = F.concat(F.lit("q"), cut)
    kind = F.col("p_partkey") % 4
    written = F.when(kind == 0, cut).when(kind == 1, again).when(kind == 2, grown).otherwise(label)
    left = t.spread("part").select("p_partkey", "p_brand", written.alias("written"))
    right = t.spread("part").select("p_brand", label.alias("label"), F.col("p_partkey").alias("ord"))
    return left, right


@query(
    "fuzzy_join",
    """
    WITH names AS (
      SELECT p_partkey, p_brand, p_name || ' ' || p_type AS label,
             CAST(p_partkey % length(p_name || ' ' || p_type) + 1 AS INT) AS pos FROM part
    ), written AS (
      SELECT p_partkey, p_brand, CASE p_partkey % 4
        WHEN 0 THEN substr(label, 1, pos - 1) || substr(label, pos + 1)
        WHEN 1 THEN 'q' || substr(label, 1, pos - 1) || substr(label, pos + 1)
        WHEN 2 THEN substr(label, 1, pos) || 'xyz' || substr(label, pos + 1)
        ELSE label END AS written FROM names
    ), targets AS (
      SELECT p_brand, label, min(p_partkey) AS ord FROM names GROUP BY ALL
    ), scored AS (
      SELECT p_partkey, w.p_brand, written, label, ord,
             damerau_levenshtein(written, label) AS distance
      FROM written w JOIN targets g ON w.p_brand = g.p_brand
    )
    SELECT p_partkey, p_brand, written, label AS matched, CAST(distance AS INT) AS distance FROM (
      SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY distance, ord) AS r
      FROM scored WHERE distance <= 2) WHERE r = 1
    """,
)
def fuzzy_join(t: Tables) -> DataFrame:
    left, right = _misspelt(t)
    return joins.fuzzy_join(left, right, "written", "label", "p_brand", "ord")


def _blocks(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    wide = F.concat(F.lit("10."), (key * 8).cast("string"), F.lit(".0.0/13"))
    narrow = F.concat(F.lit("10."), (key * 8).cast("string"), F.lit(".1.77/24"))
    blocks = F.array(
        F.struct(F.col("n_name").alias("country"), wide.alias("cidr")),
        F.struct(F.concat("n_name", F.lit("-B")).alias("country"), narrow.alias("cidr")),
    )
    return t.nation.select(F.inline(blocks))


@query(
    "geo_ip",
    """
    WITH ips AS (
      SELECT event_id, (event_id * 37) % 256 AS b, user_id % 3 AS c FROM events
    )
    SELECT event_id, '10.' || b || '.' || c || '.9' AS ip,
           CASE WHEN b % 8 = 0 AND c = 1 THEN n_name || '-B' ELSE n_name END AS country
    FROM ips LEFT JOIN nation ON n_nationkey = b // 8
    """,
)
def geo_ip(t: Tables) -> DataFrame:
    ip = F.concat_ws(
        ".",
        F.lit("10"),
        (F.col("event_id") * 37 % 256).cast("string"),
        (F.col("user_id") % 3).cast("string"),
        F.lit("9"),
    )
    return joins.geo_ip(t.events.select("event_id", ip.alias("ip")), "ip", _blocks(t))


@query(
    "geo_ip_logins",
    """
    WITH ips AS (
      SELECT event_id, CASE WHEN event_id % 5 IN (1, 3) THEN NULL WHEN event_id % 5 = 2 THEN '10.16.1.9'
        ELSE '10.' || (event_id * 37) % 256 || '.' || user_id % 3 || '.9' END AS ip FROM events
    ), parts AS (
      SELECT *, CAST(string_split(ip, '.')[2] AS INT) AS b, CAST(string_split(ip, '.')[3] AS INT) AS c FROM ips
    )
    SELECT event_id, ip, CASE WHEN b % 8 = 0 AND c = 1 THEN n_name || '-B' ELSE n_name END AS country
    FROM parts LEFT JOIN nation ON n_nationkey = b // 8
    """,
)
def geo_ip_logins(t: Tables) -> DataFrame:
    """Two fifths of the addresses missing, one fifth the same, block table dealt instead of broadcast."""
    drawn = F.concat_ws(
        ".", F.lit("10"), (F.col("event_id") * 37 % 256).cast("string"), (F.col("user_id") % 3).cast("string"), F.lit("9")
    )
    kind = F.col("event_id") % 5
    ip = F.when(kind == 2, "10.16.1.9").when(kind.isin(0, 4), drawn)
    return joins.geo_ip(t.events.select("event_id", ip.alias("ip")), "ip", _blocks(t), broadcast_blocks=0)


@query(
    "outbreak_areas",
    """
    WITH alerts AS (
      SELECT o_custkey % 25 AS n, o_orderkey % 4 AS kind, count(*) AS alerts, max(o_orderdate) AS latest FROM orders GROUP BY ALL
    ), areas AS (
      SELECT n_nationkey AS n, n_name AS country, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS level FROM nation
    )
    SELECT country, CASE WHEN level = 2 THEN country || ' DISTRICT' ELSE country || ' REGION' END AS area,
      CAST(sum(alerts) AS BIGINT) AS alerts, strftime(max(latest), '%d %b %Y') AS latest
    FROM alerts JOIN areas USING (n) WHERE kind <> 3 GROUP BY ALL
    """,
)
def outbreak_areas(t: Tables) -> DataFrame:
    """Alerts by area: level per country, gazetteer name at that level, nearest spelling within two edits."""
    nations = t.nation.select(
        F.col("n_nationkey"), F.col("n_name").alias("Country"),
        F.when(F.col("n_nationkey") % 2 == 0, 2).otherwise(1).alias("ADM_Level"),
        F.concat("n_name", F.lit(" REGION")).alias("ADM1"), F.concat("n_name", F.lit(" DISTRICT")).alias("ADM2"),
    )
    gazetteer = nations.select(
        "Country", joins.area_name(F.col("ADM_Level"), F.col("ADM1"), F.col("ADM2")).alias("area"), F.col("n_nationkey").alias("ord")
    )
    kind = F.col("o_orderkey") % 4
    area = joins.area_name(F.col("ADM_Level"), F.col("ADM1"), F.col("ADM2"))
    written = (
        F.when(kind == 0, area)
        .when(kind == 1, F.concat(F.lit("x"), area))
        .when(kind == 2, F.concat(F.substr(area, F.lit(1), F.length(area) - 2), F.lit("o")))
        .otherwise(F.concat(F.lit("far off "), area))
    )
    orders = t.orders.select("o_orderkey", "o_orderdate", (F.col("o_custkey") % 25).alias("n_nationkey"))
    alerts = orders.join(nations, "n_nationkey").select("Country", written.alias("District"), "o_orderdate")
    found = joins.fuzzy_join(alerts, gazetteer, "District", "area", "Country", "ord")
    return found.groupBy(F.col("Country").alias("country"), F.col("matched").alias("area")).agg(
        F.count(F.lit(1)).alias("alerts"), F.date_format(F.max("o_orderdate"), "dd MMM yyyy").alias("latest")
    )


# --- tags, keys, pages ---

COLOURS = ["red", "small", "widget", "ring"]


def _photos(t: Tables) -> DataFrame:
    tags = F.when(F.col("p_partkey") % 11 == 0, F.repeat(F.lit("red,"), 16)).when(
        F.col("p_partkey") % 13 != 0, F.replace(F.col("p_name"), F.lit(" "), F.lit(","))
    )
    return t.part.select("p_partkey", tags.alias("tags"))


TAG_SQL = """
WITH photos AS (
  SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN repeat('red,', 16)
    WHEN p_partkey % 13 <> 0 THEN replace(p_name, ' ', ',') END AS tags FROM part
), parts AS (
  SELECT *, string_split(coalesce(tags, ''), ',') AS l FROM photos
), flags AS (
  SELECT p_partkey, tags, CAST(len(l) AS INT) AS num_tags,
    CAST(len(l) <= 15 AND list_contains(l, 'red') AS INT) AS is_red,
    CAST(len(l) <= 15 AND list_contains(l, 'small') AS INT) AS is_small,
    CAST(len(l) <= 15 AND list_contains(l, 'widget') AS INT) AS is_widget,
    CAST(len(l) <= 15 AND list_contains(l, 'ring') AS INT) AS is_ring
  FROM parts
)
"""


@query("tag_flags", TAG_SQL + "SELECT * FROM flags")
def tag_flags(t: Tables) -> DataFrame:
    return cleaning.tag_flags(_photos(t), COLOURS)


@query(
    "flag_labels",
    TAG_SQL
    + """
    SELECT p_partkey, model AS label FROM flags,
      LATERAL (VALUES (is_red, 'RED'), (is_small, 'SMALL'), (is_widget, 'WIDGET'), (is_ring, 'RING')) v(f, model)
    WHERE f = 1
    """,
)
def flag_labels(t: Tables) -> DataFrame:
    flagged = cleaning.tag_flags(_photos(t), COLOURS)
    return cleaning.flag_labels(flagged, COLOURS, "label").select("p_partkey", "label")


@query(
    "file_keys",
    """
    SELECT page_id, md5(u) || '.' || list_last(string_split(u, '.')) AS file_key
    FROM (SELECT page_id, replace(url, '.example', '_b.example') AS u FROM pages)
    """,
)
def file_keys(t: Tables) -> DataFrame:
    url = F.replace(F.col("url"), F.lit(".example"), F.lit("_b.example"))
    return t.pages.select("page_id", cleaning.file_key(url).alias("file_key"))


@query(
    "allowed_files",
    """
    SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 0 THEN '.jpg' ELSE '.tar.png' END AS name
    FROM part WHERE p_partkey % 4 IN (0, 3)
    """,
)
def allowed_files(t: Tables) -> DataFrame:
    kind = F.col("p_partkey") % 4
    end = F.when(kind == 0, ".jpg").when(kind == 1, ".JPG").when(kind == 2, "").otherwise(".tar.png")
    names = t.part.select("p_partkey", F.concat("p_name", end).alias("name"))
    return names.where(cleaning.allowed_extension(F.col("name"), ["jpg", "png"]))


@query(
    "extract_links",
    r"""
    WITH anchors AS (
      SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>') AS l FROM pages
    ), rows AS (
      SELECT page_id, url, CAST(i - 1 AS INT) AS link_no, l[i] AS a
      FROM anchors, LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i)
    )
    SELECT page_id, url, link_no,
      CASE WHEN starts_with(h, '/') THEN 'http://site.example' || h ELSE h END AS href, label
    FROM (SELECT *, regexp_extract(a, '(?is)href="([^"]*)"', 1) AS h,
            trim(regexp_replace(a, '(?s)<[^>]*>', '', 'g')) AS label FROM rows)
    """,
)
def extract_links(t: Tables) -> DataFrame:
    return html.extract_links(t.spread("pages"), prefix=F.lit("http://site.example"))


@query(
    "page_fields",
    r"""
    SELECT page_id, url,
      CASE WHEN regexp_matches(html, '(?is)<title>(.*?)</title>')
        THEN trim(regexp_replace(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '(?s)<[^>]*>', '', 'g')) END AS title,
      CASE WHEN regexp_matches(html, '(?is)<h1[^>]*>(.*?)</h1>')
        THEN trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '(?s)<[^>]*>', '', 'g')) END AS headline,
      nullif(regexp_extract(html, '(?is)<html lang="([^"]*)"', 1), '') AS lang
    FROM pages
    """,
)
def page_fields(t: Tables) -> DataFrame:
    rules = {
        "title": r"(?is)<title>(.*?)</title>",
        "headline": r"(?is)<h1[^>]*>(.*?)</h1>",
        "lang": r'(?is)<html lang="([^"]*)"',
    }
    return html.extract_fields(t.spread("pages"), rules).select("page_id", "url", "title", "headline", "lang")


@query(
    "alert_list",
    """
    SELECT p_brand AS country, strftime(DATE '2014-01-01' + CAST(p_partkey % 300 AS INT), '%-d %B %Y') AS "Date",
      'http://who.example/csr/' || p_partkey AS "URL", p_name || ', update' AS "Headline"
    FROM part WHERE p_partkey % 7 <> 0
    """,
)
def alert_list(t: Tables) -> DataFrame:
    """Alerts read from one list page per brand; items without a link are none."""
    day = F.date_format(F.date_add(F.lit("2014-01-01").cast("date"), (F.col("p_partkey") % 300).cast("int")), "d MMMM yyyy")
    link = F.format_string('<li class="n"><a class="d" href="/csr/%d">%s</a> <span>%s, <b>update</b></span></li>', "p_partkey", day, "p_name")
    item = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("<li>"), "p_name", F.lit("</li>"))).otherwise(link)
    # some fifty items a page, as list pages have
    lists = t.part.groupBy("p_brand", F.floor(F.col("p_partkey") / 1000).alias("page")).agg(F.collect_list(item).alias("items"))
    pages = lists.select("p_brand", F.concat(F.lit("<ul>"), F.array_join("items", "\n"), F.lit("</ul>")).alias("html"))
    found = html.extract_alerts(pages, "http://who.example")
    part = t.part.select(
        F.concat(F.lit("http://who.example/csr/"), F.col("p_partkey").cast("string")).alias("URL"), F.col("p_brand").alias("country")
    )
    return found.join(part, "URL").select("country", "Date", "URL", "Headline")


@query(
    "photo_pages",
    """
    SELECT 'http://p.example/' || p_partkey AS "PageURL", 'http://i.example/' || p_partkey || '.jpg' AS "ImageURL",
      CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS "AircraftModel", CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS "Airline",
      p_name AS "Photographer", '' AS "Size", 'No' AS "Permission"
    FROM part
    """,
)
def photo_pages(t: Tables) -> DataFrame:
    """The fields of one photo page per part; some pages lack the model or the airline."""
    key = F.col("p_partkey").cast("string")

    def paragraph(label: str, value: str, every: int):
        said = F.concat(F.lit(f"<p class='a'>{label}: "), F.col(value), F.lit("</p>"))
        return F.when(F.col("p_partkey") % every != 0, said).otherwise("")

    page = F.concat(
        F.lit('<img src="/logo.png"><img alt="x" class="main-image" src="http://i.example/'), key, F.lit('.jpg">'),
        F.lit('<section class="additional-info aircraft">'), paragraph("Aircraft", "p_type", 5), paragraph("Airline", "p_brand", 3),
        F.lit('</section><section class="additional-info photographer"><h2>By</h2><p> <a href="/u">'), "p_name", F.lit("</a> </p></section>"),
    )
    return html.extract_photo_fields(t.part.select(F.concat(F.lit("http://p.example/"), key).alias("url"), page.alias("html")))


@query(
    "single_detection",
    """
    SELECT o_orderkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
    """,
)
def single_detection(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return cleaning.drop_multi_detection(t.orders.select("o_orderkey"), lines, "o_orderkey")


@query(
    "largest_box",
    """
    SELECT o_orderkey AS frame, coalesce(x, -1) AS x, coalesce(y, -1) AS y, coalesce(w, -1) AS w, coalesce(h, -1) AS h
    FROM orders LEFT JOIN (
      SELECT l_orderkey, l_partkey AS x, l_suppkey AS y, CAST(l_quantity AS INT) AS w, CAST(l_quantity AS INT) % 9 + 1 AS h,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS INT) * (CAST(l_quantity AS INT) % 9 + 1) DESC,
          l_linenumber, l_partkey, l_suppkey) AS r
      FROM lineitem) ON l_orderkey = o_orderkey AND r = 1
    """,
)
def largest_box(t: Tables) -> DataFrame:
    side = F.col("l_quantity").cast("int")
    boxes = t.lineitem.select(
        F.col("l_orderkey").alias("frame"),
        F.col("l_linenumber").alias("pos"),
        F.col("l_partkey").alias("x"),
        F.col("l_suppkey").alias("y"),
        side.alias("w"),
        (side % 9 + 1).alias("h"),
    )
    # part and supplier settle the order of lines that share a number
    return aggregates.largest_box(boxes, "frame", ["pos", "x", "y"], t.orders.select(F.col("o_orderkey").alias("frame")))


# --- rankings ---


@query(
    "top_orders",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_orders(t: Tables) -> DataFrame:
    slim = t.orders.select("o_orderkey", "o_totalprice")
    return aggregates.top_rows(slim, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query(
    "top_orders_per_customer",
    """
    SELECT o_custkey, o_orderkey, CAST(r AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r
      FROM orders) WHERE r <= 3
    """,
)
def top_orders_per_customer(t: Tables) -> DataFrame:
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    slim = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return aggregates.top_per_group(slim, ["o_custkey"], order, 3).drop("o_totalprice")


@query(
    "rank_by_score",
    """
    SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer
    """,
)
def rank_by_score(t: Tables) -> DataFrame:
    slim = t.customer.select("c_custkey", "c_acctbal")
    return aggregates.ranked_by_score(slim, "c_acctbal", ["c_custkey"], bands=1)


@query(
    "leaderboard",
    """
    WITH fresh AS (
      SELECT 'm' || l_suppkey AS model, count(*) FILTER (l_returnflag = 'R') / count(*) AS score
      FROM lineitem GROUP BY l_suppkey
    ), previous AS (
      SELECT 'm' || p_size AS model, count(*) FILTER (p_type = 'ECONOMY') / count(*) AS score
      FROM part GROUP BY p_size
    ), merged AS (
      SELECT * FROM previous UNION ALL SELECT * FROM fresh WHERE model NOT IN (SELECT model FROM previous)
    )
    SELECT model, round(score, 9) AS score, row_number() OVER (ORDER BY score DESC, model) AS rank FROM merged
    """,
)
def leaderboard(t: Tables) -> DataFrame:
    def share(df, key, hit):
        model = F.concat(F.lit("m"), F.col(key).cast("string")).alias("model")
        return df.groupBy(model).agg((F.count_if(hit) / F.count(F.lit(1))).alias("score"))

    fresh = share(t.lineitem, "l_suppkey", F.col("l_returnflag") == "R")
    previous = share(t.part, "p_size", F.col("p_type") == "ECONOMY")
    board = models.leaderboard(fresh, previous, prefer="old")
    return board.withColumn("score", F.round("score", 9))


# --- graph: parts linked as a binary tree ---


def _tree(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.where(key > 0).select(
        F.floor((key - 1) / 2).cast("string").alias("src"), key.cast("string").alias("dst")
    )


@query(
    "path_enumeration",
    """
    WITH RECURSIVE edges AS (
      SELECT CAST((p_partkey - 1) // 2 AS VARCHAR) AS src, CAST(p_partkey AS VARCHAR) AS dst
      FROM part WHERE p_partkey > 0
    ), walk AS (
      SELECT src || '>' || dst AS path, dst AS tail, 1 AS length FROM edges
      UNION ALL
      SELECT path || '>' || dst, dst, length + 1 FROM walk JOIN edges ON tail = src WHERE length < 4
    )
    SELECT path, length FROM walk
    """,
)
def path_enumeration(t: Tables) -> DataFrame:
    paths = graph.enumerate_paths(_tree(t), max_len=4)
    return paths.select(F.array_join("path", ">").alias("path"), "length")


@query(
    "path_cycles",
    """
    WITH RECURSIVE nodes AS (
      SELECT p_partkey AS k, p_partkey // 400 * 400 AS b, p_partkey % 400 AS r FROM part
    ), edges AS (
      SELECT CAST(b + r AS VARCHAR) AS src, CAST(b + (r + 1 + k % 3 * 7) % 400 AS VARCHAR) AS dst FROM nodes
      UNION SELECT CAST(b + r AS VARCHAR), CAST(b + (r + 11) % 400 AS VARCHAR) FROM nodes WHERE k % 2 = 0
      UNION SELECT CAST(b + (r + 1 + k % 3 * 7) % 400 AS VARCHAR), CAST(b + r AS VARCHAR) FROM nodes WHERE k % 5 = 0
    ), walk AS (
      SELECT src || '>' || dst AS path, dst AS tail, 1 AS length, [src || '>' || dst] AS used FROM edges
      UNION ALL
      SELECT path || '>' || dst, dst, length + 1, list_append(used, src || '>' || dst) FROM walk JOIN edges ON tail = src
      WHERE length < 5 AND NOT list_contains(used, src || '>' || dst)
    )
    SELECT path, length FROM walk
    """,
)
def path_cycles(t: Tables) -> DataFrame:
    """Paths of a graph with rings and back links: no path uses an edge twice."""
    key = F.col("p_partkey")

    def in_ring(step):
        return F.floor(key / 400) * 400 + (key + step) % 400

    here, there, aside = (in_ring(step).cast("string") for step in (F.lit(0), 1 + key % 3 * 7, F.lit(11)))
    edges = (
        t.part.select(here.alias("src"), there.alias("dst"))
        .unionByName(t.part.where(key % 2 == 0).select(here.alias("src"), aside.alias("dst")))
        .unionByName(t.part.where(key % 5 == 0).select(there.alias("src"), here.alias("dst")))
    )
    paths = graph.enumerate_paths(edges, max_len=5)
    return paths.select(F.array_join("path", ">").alias("path"), "length")


@query(
    "graph_nodes",
    """
    WITH edges AS (
      SELECT DISTINCT o_custkey % 500 AS src, o_custkey // 7 AS dst FROM orders
    )
    SELECT page, (SELECT count(*) FROM edges e WHERE e.src = page) AS out_links FROM (
      SELECT src AS page FROM edges UNION SELECT dst FROM edges)
    """,
)
def graph_nodes(t: Tables) -> DataFrame:
    raw = t.orders.select(
        (F.col("o_custkey") % 500).alias("src"), F.floor(F.col("o_custkey") / 7).alias("dst")
    )
    nodes, edges = graph.build_graph(raw)
    degree = edges.groupBy(F.col("src").alias("page")).agg(F.count(F.lit(1)).alias("out_links"))
    return cleaning.filled(joins.attach(nodes, degree, "page"), {"out_links": 0})
