from pyspark.sql import functions as F

from logloom.functions import arrays, dates, text, weblog


def values(spark, data, expr, schema="v STRING"):
    rows = spark.createDataFrame([(d,) for d in data], schema).select(expr(F.col("v")).alias("r"))
    return [r.r for r in rows.collect()]


def test_java_split(spark):
    got = values(spark, ["a  b a", "", "x  ", " ", "  ", " a", None], text.java_split)
    assert got == [["a", "", "b", "a"], [""], ["x"], [], [], ["", "a"], None]


def test_split_trimmed(spark):
    assert values(spark, ["a, b ,c"], text.split_trimmed) == [["a", "b", "c"]]


def test_letters_and_whitespace(spark):
    assert values(spark, ["Ab1-c"], text.letters_only) == ["ab  c"]
    assert values(spark, ["a\tb\r\nc"], text.flatten_whitespace) == ["a b  c"]
    assert values(spark, ["\n x\r\n\ty  "], text.strip_line_indents) == ["xy"]
    assert values(spark, ["a+b\tc"], text.spaces_and_plus) == ["a b c"]
    assert values(spark, ["--é, b_c!"], text.strip_non_word) == ["é b_c"]


def test_squeeze_repeats(spark):
    got = values(spark, ["AAAAARGH", "daaaarling", "ARRGGHH"], text.squeeze_repeats)
    assert got == ["AARGH", "daarling", "ARRGGHH"]


def test_urls_and_emails(spark):
    tokens = [["see", "http://x", "https:", "www.a.b", "mailto:joe@x", "note:", "at:80", "ok"]]
    kept = values(spark, tokens, text.drop_urls, "v ARRAY<STRING>")
    assert kept == [["see", "note:", "at:80", "ok"]]
    got = values(
        spark,
        ["mail joe@x.org and ann at y dot com now", "none here", "look at me"],
        text.remove_emails,
    )
    assert got == ["mail   and   now", "none here", "look at me"]


def test_token_filters(spark):
    a = "v ARRAY<STRING>"
    words = [["the", "The", "cat", "!", "urllink", "..", "", " ", "."]]
    skip = text.excluded_tokens()
    assert values(spark, words, lambda c: text.drop_tokens(c, skip), a) == [
        ["The", "cat", "..", "", " "]
    ]
    assert values(spark, words, text.drop_blank, a) == [["the", "The", "cat", "!", "urllink"]]
    lengths = [["a", "ab", "a" * 15, "a" * 16]]
    assert values(spark, lengths, text.keep_lengths, a) == [["ab", "a" * 15]]
    assert values(spark, ["The CAT sat, a while"], text.clean_post) == ["cat sat"]


def test_words_and_terms(spark):
    assert values(spark, ["A b-cd, Été x_1"], text.terms) == [["cd", "été", "x_1"]]
    assert values(spark, ["It's a b-c\tD"], text.vocabulary_words) == [
        ["it's", "a", "b", "c", "d"]
    ]
    assert values(spark, ["['a', 'b']", '["c"]'], text.parse_token_list) == [["a", "b"], ["c"]]


def test_dates(spark):
    got = values(
        spark,
        ["14,May,2004", "03,août,2003", "1,März,2002", "2004-05-06", "junk", "31,June,2004", ""],
        lambda c: dates.iso_or_empty(dates.parse_post_date(c)),
    )
    assert got == ["2004-05-14", "2003-08-03", "2002-03-01", "2004-05-06", "", "", ""]
    alerts = values(spark, ["18-JUN-2014", "1-mar-2014", "x"], dates.parse_alert_date)
    assert [str(d) for d in alerts] == ["2014-06-18", "2014-03-01", "None"]
    log = values(
        spark,
        ["[07/Feb/2014:17:59:07 +0000]", "[bad]"],
        lambda c: dates.parse_log_time(c).cast("string"),
    )
    assert log == ["2014-02-07 17:59:07", None]


def test_request_uri(spark):
    lines = ["GET / HTTP/1.1", "GET /a/b.html?x=1 HTTP/1.1", "junk", "GET"]
    assert values(spark, lines, weblog.request_uri) == ["/1.1", "/a/b.html", "", ""]
    strict = values(spark, lines, lambda c: weblog.request_uri(c, strict=True))
    assert strict == ["/", "/a/b.html", "", ""]


def test_is_page(spark):
    assert values(spark, ["/a.js", "/a.JS", "/a.png", "/b.css"], weblog.is_page) == [
        False,
        True,
        True,
        False,
    ]


def test_cookies(spark):
    maps = [{"a": "1", "b": "2"}, {}, None]
    assert values(spark, maps, weblog.cookie_names, "v MAP<STRING,STRING>") == ["a;b", "-", "-"]
    got = values(spark, ["x", None], lambda c: weblog.cookie_pair(F.lit("sid"), c))
    assert got == ["sid=x", "-"]
    got = values(spark, ['"-"', '"k=v"', "-"], weblog.session_value)
    assert got == [None, "k=v", None]


def test_pad_front(spark):
    data = [[1, 2], [1, 2, 3, 4, 5], []]
    got = values(spark, data, lambda c: arrays.pad_front(c, 3), "v ARRAY<INT>")
    assert got == [[0, 1, 2], [3, 4, 5], [0, 0, 0]]


def test_argmax_and_ranks(spark):
    got = values(spark, [[0.1, 0.7, 0.7]], arrays.argmax, "v ARRAY<DOUBLE>")
    assert got == [1]
    df = spark.createDataFrame([(["a", "b", "c"], [0.2, 0.4, 0.4])], "n ARRAY<STRING>, p ARRAY<DOUBLE>")
    pairs = df.select(arrays.rank_pairs(F.col("n"), F.col("p")).alias("r")).first().r
    assert [(p.name, p.prob) for p in pairs] == [("b", 0.4), ("c", 0.4), ("a", 0.2)]
