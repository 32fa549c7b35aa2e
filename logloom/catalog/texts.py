"""Text cleaning, tokens, vocabularies and TF-IDF on ``documents``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.catalog.base import Tables, query
from logloom.functions import text as tx
from logloom.functions.dates import iso_or_empty, parse_alert_date, parse_post_date
from logloom.functions.weblog import cookie_names, cookie_pair
from logloom.operators import features, text
from logloom.plans.rows import elements


def quoted(words) -> str:
    """A SQL list literal."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def digest(column: Column) -> Column:
    return F.md5(column.cast("binary"))


@query(
    "word_count",
    r"""
    WITH cut AS (
      SELECT CASE WHEN length(text) = 0 THEN ['']
                  WHEN length(rtrim(text, ' ')) = 0 THEN []
                  ELSE string_split(rtrim(text, ' '), ' ') END AS l FROM documents
    )
    SELECT word, count(*) AS n FROM (SELECT unnest(l) AS word FROM cut) GROUP BY word
    """,
)
def word_count(t: Tables) -> DataFrame:
    return text.word_count(t.spread("documents"), "text").withColumnRenamed("count", "n")


@query(
    "whitespace_cleaning",
    r"""
    SELECT doc_id, md5(translate(text, chr(13) || chr(10) || chr(9), '   ')) AS flat,
      md5(regexp_replace(text, '[\s+]', ' ', 'g')) AS plus,
      md5(regexp_replace(lower(text), '[^a-zA-Z]', ' ', 'g')) AS letters,
      md5(trim(regexp_replace(text, '[^\p{L}\p{N}_]+', ' ', 'g'))) AS words,
      md5(regexp_replace(replace(text, chr(13) || chr(10) || chr(9), ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS body
    FROM documents
    """,
)
def whitespace_cleaning(t: Tables) -> DataFrame:
    c = F.col("text")
    return t.spread("documents").select(
        "doc_id",
        digest(tx.flatten_whitespace(c)).alias("flat"),
        digest(tx.spaces_and_plus(c)).alias("plus"),
        digest(tx.letters_only(c)).alias("letters"),
        digest(tx.strip_non_word(c)).alias("words"),
        digest(tx.strip_line_indents(c)).alias("body"),
    )


@query(
    "squeeze_repeats",
    r"""
    WITH chars AS (SELECT doc_id, string_split(text, '') AS c FROM documents)
    SELECT doc_id, md5(array_to_string(list_filter(c, lambda x, i:
      i <= 2 OR x = chr(10) OR x <> c[i - 1] OR x <> c[i - 2]), '')) AS squeezed FROM chars
    """,
)
def squeeze_repeats(t: Tables) -> DataFrame:
    return t.spread("documents").select("doc_id", digest(tx.squeeze_repeats(F.col("text"))).alias("squeezed"))


EMAIL_SQL = "'" + tx.EMAIL_PATTERN.replace("'", "''") + "'"


@query(
    "remove_emails",
    f"SELECT doc_id, md5(regexp_replace(text, {EMAIL_SQL}, ' ', 'g')) AS clean FROM documents",
)
def remove_emails(t: Tables) -> DataFrame:
    return t.spread("documents").select("doc_id", digest(tx.remove_emails(F.col("text"))).alias("clean"))


@query(
    "url_tokens",
    r"""
    WITH tokens AS (
      SELECT doc_id, list_filter(regexp_split_to_array(text, '[\s\p{Z}]+'), lambda x: x <> '') AS l FROM documents
    )
    SELECT doc_id, len(l) AS n_tokens, len(list_filter(l, lambda x: NOT (starts_with(x, 'http')
      OR starts_with(x, 'www') OR regexp_matches(x, '^[A-Za-z][A-Za-z0-9+.\-]*:.*[^0-9]')))) AS n_kept
    FROM tokens
    """,
)
def url_tokens(t: Tables) -> DataFrame:
    tokens = tx.whitespace_tokens(F.col("text"))
    return t.spread("documents").select(
        "doc_id",
        F.size(tokens).cast("bigint").alias("n_tokens"),
        F.size(tx.drop_urls(tokens)).cast("bigint").alias("n_kept"),
    )


CLEAN_SQL = r"""
SELECT doc_id, md5(array_to_string(list_filter(
  regexp_split_to_array(regexp_replace(lower(text), '[^a-zA-Z]', ' ', 'g'), '[\s\p{{Z}}]+'),
  lambda x: x <> '' AND length(x) BETWEEN 2 AND 15 AND NOT list_contains({words}, x)), ' ')) AS clean
FROM documents
"""
# the first half of the pipeline, then lemmas (a mapping of tokens), then the second half
TOKEN_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(text, {email}, ' ', 'g'), '[\s\p{{Z}}]+'),
    lambda x: x <> '' AND NOT list_contains({words}, x)) AS l FROM documents
), linked AS (
  SELECT doc_id, list_filter(l, lambda x: NOT (starts_with(x, 'http') OR starts_with(x, 'www')
    OR regexp_matches(x, '^[A-Za-z][A-Za-z0-9+.\-]*:.*[^0-9]'))) AS l FROM words
), squeezed AS (
  SELECT doc_id, list_transform(l, lambda x: array_to_string(list_filter(string_split(x, ''), lambda c, i:
    i <= 2 OR c <> string_split(x, '')[i - 1] OR c <> string_split(x, '')[i - 2]), '')) AS l FROM linked
), lowered AS (
  SELECT doc_id, list_filter(list_transform(l, lambda x: trim(lower({lemma}))),
    lambda x: NOT list_contains({words}, x) AND NOT regexp_matches(x, '^\.*$') AND trim(x) <> '') AS l FROM squeezed
)
SELECT doc_id, len(l) AS n_tokens, md5(array_to_string(l, ' ')) AS tokens FROM lowered
"""


def _summary(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        digest(tx.join_tokens(F.col("tokens"))).alias("tokens"),
    )


WORDS = quoted(tx.excluded_tokens())
PLAIN = "x"
STEMMED = "CASE WHEN regexp_matches(x, '^[a-z]{3,}ed$') THEN left(x, length(x) - 2) ELSE x END"


def _token_sql(lemma: str) -> str:
    return TOKEN_SQL.format(words=WORDS, email=EMAIL_SQL, lemma=lemma)


@query("clean_post", CLEAN_SQL.format(words=WORDS))
def clean_post(t: Tables) -> DataFrame:
    return t.spread("documents").select("doc_id", digest(tx.clean_post(F.col("text"))).alias("clean"))


@query("tokenize", _token_sql(PLAIN))
def tokenize(t: Tables) -> DataFrame:
    return _summary(text.tokenize(t.spread("documents"), "doc_id", "text"))


def _lemmas(t: Tables) -> DataFrame:
    # "walked" -> "walk" for every such word of the corpus
    basic = tx.basic_tokens(F.col("text"), tx.excluded_tokens())
    tokens = elements(t.spread("documents"), [], basic, "token")
    known = tokens.where(F.col("token").rlike("^[a-z]{3,}ed$")).distinct()
    return known.select("token", F.regexp_replace("token", "ed$", "").alias("value"))


@query("tokenize_lemmas", _token_sql(STEMMED))
def tokenize_lemmas(t: Tables) -> DataFrame:
    return _summary(text.tokenize(t.spread("documents"), "doc_id", "text", _lemmas(t)))


@query(
    "expand_contractions",
    r"""
    WITH words AS (
      SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS l FROM documents
    )
    SELECT doc_id, md5(array_to_string(list_transform(l, lambda x:
      CASE WHEN regexp_matches(x, '^th[a-z]{6,}$') THEN 'th ' || substr(x, 3) ELSE x END), ' ')) AS tokens
    FROM words
    """,
)
def expand_contractions(t: Tables) -> DataFrame:
    docs = t.spread("documents").select(
        "doc_id", F.filter(F.split("text", " ", -1), lambda x: x != "").alias("tokens")
    )
    words = elements(docs, [], "tokens", "token").where(F.col("token").rlike("^th[a-z]{6,}$"))
    table = words.distinct().select(
        "token", F.concat(F.lit("th "), F.expr("substring(token, 3)")).alias("value")
    )
    out = text.expand_contractions(docs, "doc_id", "tokens", table)
    return out.select("doc_id", digest(tx.join_tokens(F.col("tokens"))).alias("tokens"))


@query(
    "text_dates",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS english, strftime(o_orderdate, '%Y-%m-%d') AS french,
      CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS alert
    FROM orders
    """,
)
def text_dates(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    french = F.array(
        *[F.lit(m) for m in (
            "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()
        )]
    )
    written = F.concat_ws(",", F.dayofmonth(day).cast("string"), F.get(french, F.month(day) - 1), F.year(day).cast("string"))
    alert = F.when(F.col("o_orderkey") % 7 == 0, "soon").otherwise(F.upper(F.date_format(day, "dd-MMM-yyyy")))
    return t.orders.select(
        "o_orderkey",
        iso_or_empty(parse_post_date(F.date_format(day, "dd,MMMM,yyyy"))).alias("english"),
        iso_or_empty(parse_post_date(written)).alias("french"),
        iso_or_empty(parse_alert_date(alert)).alias("alert"),
    )


@query(
    "token_lists",
    """
    SELECT doc_id, md5(array_to_string(list_filter(string_split(lower(text), ' '),
      lambda x: regexp_full_match(x, '[a-z]+')), '|')) AS tokens FROM documents
    """,
)
def token_lists(t: Tables) -> DataFrame:
    words = F.filter(F.split(F.lower("text"), " ", -1), lambda x: x.rlike("^[a-z]+$"))
    stored = F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']"))
    stored = F.when(F.size(words) == 0, "[]").otherwise(stored)
    return t.spread("documents").select(
        "doc_id", digest(F.array_join(tx.parse_token_list(stored), "|")).alias("tokens")
    )


@query(
    "cookies",
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '-' ELSE 'sid=' || user_id END AS pair,
      CASE event_id % 3 WHEN 0 THEN '-' WHEN 1 THEN 'sid' ELSE 'sid;' || event_type END AS names
    FROM events
    """,
)
def cookies(t: Tables) -> DataFrame:
    kind, user = F.col("event_id") % 3, F.col("user_id").cast("string")
    value = F.when(kind != 0, user)
    jar = F.when(kind == 1, F.create_map(F.lit("sid"), user)).when(
        kind == 2, F.create_map(F.lit("sid"), user, "event_type", user)
    )
    return t.events.select(
        "event_id",
        cookie_pair(F.lit("sid"), value).alias("pair"),
        cookie_names(jar).alias("names"),
    )


# --- terms ---


def docs(t: Tables) -> DataFrame:
    return t.spread("documents").select("doc_id", tx.terms(F.col("text")).alias("tokens"))


TERMS_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS l FROM documents
), uses AS (
  SELECT doc_id, unnest(l) AS term FROM docs
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM uses GROUP BY ALL
), total AS (
  SELECT count(*) AS n FROM documents
), dfs AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term
), idfs AS (
  SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM dfs, total
), weights AS (
  SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS weight
  FROM tf JOIN idfs USING (term)
)
"""


@query("term_frequencies", TERMS_SQL + "SELECT term, df, cf FROM dfs")
def term_frequencies(t: Tables) -> DataFrame:
    return text.term_frequencies(docs(t), "tokens")


@query("distinct_tokens", TERMS_SQL + "SELECT count(*) AS n_distinct FROM dfs")
def distinct_tokens(t: Tables) -> DataFrame:
    return text.distinct_elements(docs(t), "tokens")


@query("tfidf", TERMS_SQL + "SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
def tfidf(t: Tables) -> DataFrame:
    weights = features.tfidf(docs(t), "doc_id", "tokens")
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "tfidf_limited",
    TERMS_SQL
    + """
    , kept AS (SELECT term, idf FROM idfs, total WHERE df >= 5 AND df <= 0.5 * n),
    logs AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN kept USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM logs
    """,
)
def tfidf_limited(t: Tables) -> DataFrame:
    weights = features.tfidf(docs(t), "doc_id", "tokens", min_df=5, max_df=0.5, sublinear=True)
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "feature_counts",
    TERMS_SQL
    + """
    SELECT min_df, count(*) FILTER (df >= min_df * n) AS features
    FROM dfs, total, (SELECT unnest([0.001, 0.005, 0.01, 0.1]::DOUBLE[]) AS min_df) GROUP BY min_df
    """,
)
def feature_counts(t: Tables) -> DataFrame:
    return features.feature_counts(docs(t), "tokens", [0.001, 0.005, 0.01, 0.1])


@query(
    "top_terms",
    TERMS_SQL
    + """
    SELECT doc_id, term, CAST(r AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term) AS r FROM weights)
    WHERE r <= 3
    """,
)
def top_terms(t: Tables) -> DataFrame:
    weights = features.tfidf(docs(t), "doc_id", "tokens")
    return features.top_terms(weights.withColumn("weight", F.round("weight", 9)), "doc_id", 3).drop("weight")


@query(
    "top_corpus_terms",
    TERMS_SQL
    + """
    SELECT term, round(max(weight), 6) AS weight FROM weights GROUP BY term
    ORDER BY round(max(weight), 9) DESC, term LIMIT 20
    """,
)
def top_corpus_terms(t: Tables) -> DataFrame:
    weights = features.tfidf(docs(t), "doc_id", "tokens").withColumn("weight", F.round("weight", 9))
    return features.top_corpus_terms(weights, 20).withColumn("weight", F.round("weight", 6))


# --- vocabulary and sequences ---


def vocabulary_docs(t: Tables) -> DataFrame:
    return t.spread("documents").select("doc_id", tx.vocabulary_words(F.col("text")).alias("words"))


VOCAB_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split(translate(lower(text), '!"#$%&()*+,-./:;<=>?@[\]^_`{|}~' || chr(9) || chr(10),
    repeat(' ', 34)), ' '), lambda x: x <> '') AS l FROM documents
), uses AS (
  SELECT doc_id, unnest(l) AS word, unnest(range(len(l))) AS p FROM docs
), vocab AS (
  SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, doc_id, p) AS INT) AS idx FROM (
    SELECT word, count(*) AS n, min((doc_id, p))[1] AS doc_id, min((doc_id, p))[2] AS p FROM uses GROUP BY word)
)
"""


@query("fit_vocabulary", VOCAB_SQL + "SELECT word, n, idx FROM vocab")
def fit_vocabulary(t: Tables) -> DataFrame:
    return text.fit_vocabulary(vocabulary_docs(t), "doc_id", "words")


ENCODE_SQL = (
    VOCAB_SQL
    + """
    , found AS (
      SELECT doc_id, list(idx ORDER BY p) AS s FROM uses JOIN vocab USING (word) {where} GROUP BY doc_id
    ), padded AS (
      SELECT d.doc_id, list_concat(list_transform(range(40), lambda x: 0::INT), coalesce(s, [])) AS s
      FROM docs d LEFT JOIN found f ON d.doc_id = f.doc_id
    )
    SELECT doc_id, array_to_string(list_slice(s, len(s) - 39, len(s)), ' ') AS sequence FROM padded
    """
)


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.array_join(F.col("sequence").cast("array<string>"), " ").alias("sequence"))


@query("encode_sequences", ENCODE_SQL.replace("{where}", "WHERE idx < 500"))
def encode_sequences(t: Tables) -> DataFrame:
    rows = vocabulary_docs(t)
    vocabulary = text.fit_vocabulary(rows, "doc_id", "words", cap=500)
    return _as_text(text.encode(rows, "doc_id", "words", vocabulary, 40, cap=500))


@query("encode_all_words", ENCODE_SQL.replace("{where}", ""))
def encode_all_words(t: Tables) -> DataFrame:
    rows = vocabulary_docs(t)
    vocabulary = text.fit_vocabulary(rows, "doc_id", "words")
    return _as_text(text.encode(rows, "doc_id", "words", vocabulary, 40))


@query(
    "label_index",
    """
    SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INT) AS idx
    FROM (SELECT DISTINCT source FROM documents)
    """,
)
def label_index(t: Tables) -> DataFrame:
    return features.label_index(t.documents, "source")


@query(
    "label_index_first_seen",
    """
    SELECT source AS label, CAST(row_number() OVER (ORDER BY f) - 1 AS INT) AS idx
    FROM (SELECT source, min(doc_id) AS f FROM documents GROUP BY source)
    """,
)
def label_index_first_seen(t: Tables) -> DataFrame:
    return features.label_index(t.documents, "source", first_seen="doc_id")


@query(
    "stable_split",
    """
    SELECT doc_id, CAST('0x' || left(md5(doc_id || '-42'), 8) AS BIGINT) % 10000 < 3300 AS is_test FROM documents
    """,
)
def stable_split(t: Tables) -> DataFrame:
    return features.stable_split(t.documents.select("doc_id"), "doc_id", 0.33, seed=42)
