"""Word vectors, document vectors and predictions on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.catalog.base import Tables, query
from logloom.catalog.texts import TERMS_SQL, VOCAB_SQL, docs, vocabulary_docs
from logloom.operators import aggregates, features, text
from logloom.plans.rows import elements

DIM = 64


def _word_vectors(t: Tables, vocabulary: DataFrame) -> DataFrame:
    """(word, vec): the n-th vocabulary word gets the n-th vector."""
    vectors = t.embeddings.select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vec"))
    return vocabulary.join(vectors, "idx").select("word", "vec")


def _term_vectors(t: Tables) -> DataFrame:
    """(word, vec): terms in alphabetical order, each with one of the vectors."""
    terms = features.label_index(elements(docs(t), [], F.array_distinct("tokens"), "term"), "term")
    vectors = t.embeddings.select(F.col("vec_id").alias("idx"), F.col("embedding").alias("vec"))
    return terms.join(vectors, "idx").select(F.col("label").alias("word"), "vec")


@query(
    "embedding_matrix",
    VOCAB_SQL
    + """
    SELECT idx, word, coalesce(round(CAST(embedding[1] AS DOUBLE), 6), 0) AS v0,
      coalesce(round(CAST(embedding[64] AS DOUBLE), 6), 0) AS v63
    FROM vocab LEFT JOIN embeddings ON vec_id = idx AND idx % 3 <> 0 WHERE idx < 1000
    """,
)
def embedding_matrix(t: Tables) -> DataFrame:
    vocabulary = text.fit_vocabulary(vocabulary_docs(t), "doc_id", "words")
    vectors = _word_vectors(t, vocabulary.where("idx % 3 <> 0"))
    matrix = features.embedding_matrix(vocabulary, vectors, DIM, cap=1000)
    return matrix.select(
        "idx",
        "word",
        F.round(F.col("vec")[0].cast("double"), 6).alias("v0"),
        F.round(F.col("vec")[63].cast("double"), 6).alias("v63"),
    )


MEAN_SQL = (
    TERMS_SQL
    + """
    , ranked AS (
      SELECT term, idf, row_number() OVER (ORDER BY term) - 1 AS idx FROM idfs
    ), vecs AS (
      SELECT term, idf, embedding AS v FROM ranked JOIN embeddings ON vec_id = idx
    ), sums AS (
      SELECT doc_id, sum(tf) AS n, sum(tf * {w} * CAST(v[1] AS DOUBLE)) AS s0,
        sum(tf * {w} * CAST(v[33] AS DOUBLE)) AS s32, sum(tf * {w} * CAST(v[64] AS DOUBLE)) AS s63
      FROM tf JOIN vecs USING (term) GROUP BY doc_id
    ), means AS (
      SELECT d.doc_id, s0 / n AS v0, s32 / n AS v32, s63 / n AS v63
      FROM documents d LEFT JOIN sums s ON s.doc_id = d.doc_id
    )
    """
)


def _three(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", *[F.round(F.col("features")[i], 6).alias(f"v{i}") for i in (0, 32, 63)]
    )


def _means_sql(w: str, fill: str) -> str:
    columns = ", ".join(f"round(coalesce(v{i}, {fill.format(i=i)}), 6) AS v{i}" for i in (0, 32, 63))
    return MEAN_SQL.replace("{w}", w) + f"SELECT doc_id, {columns} FROM means"


@query("mean_embedding", _means_sql("1", "0"))
def mean_embedding(t: Tables) -> DataFrame:
    return _three(features.mean_embedding(docs(t), "doc_id", "tokens", _term_vectors(t), DIM))


@query("tfidf_embedding", _means_sql("idf", "0"))
def tfidf_embedding(t: Tables) -> DataFrame:
    rows = docs(t)
    return _three(features.tfidf_embedding(rows, "doc_id", "tokens", _term_vectors(t), DIM, rows))


@query("impute_mean", _means_sql("1", "(SELECT avg(v{i}) FROM means)"))
def impute_mean(t: Tables) -> DataFrame:
    rows = features.mean_embedding(docs(t), "doc_id", "tokens", _term_vectors(t), DIM, missing="null")
    return _three(features.impute_mean(rows, "features", DIM))


@query(
    "rank_predictions",
    """
    SELECT vec_id, CAST(r AS INT) AS rank, 'c' || i AS name, p AS prob FROM (
      SELECT vec_id, i - 1 AS i, round(CAST(embedding[i] AS DOUBLE), 2) AS p,
        row_number() OVER (PARTITION BY vec_id ORDER BY round(CAST(embedding[i] AS DOUBLE), 2) DESC, i) AS r
      FROM embeddings, (SELECT unnest(range(1, 65)) AS i))
    """,
)
def rank_predictions(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(f"c{i}") for i in range(DIM)])
    probs = F.transform("embedding", lambda x: F.round(x.cast("double"), 2))
    rows = t.embeddings.select("vec_id", names.alias("names"), probs.alias("probs"))
    return aggregates.rank_predictions(rows, "names", "probs", ["vec_id"])


def _decoded(t: Tables) -> DataFrame:
    labels = t.nation.select(F.col("n_name").alias("label"), F.col("n_nationkey").alias("idx"))
    return features.decode_predictions(t.embeddings, "embedding", labels)


DECODED_SQL = """
WITH best AS (
  SELECT vec_id, label, list_position(embedding, list_max(embedding)) - 1 AS i FROM embeddings
), decoded AS (
  SELECT vec_id, n_name AS pred, 'NATION_' || label AS actual FROM best LEFT JOIN nation ON n_nationkey = i
)
"""


@query("argmax_label", DECODED_SQL + "SELECT vec_id, pred FROM decoded")
def argmax_label(t: Tables) -> DataFrame:
    return _decoded(t).select("vec_id", "pred")


@query(
    "mismatch_percent",
    DECODED_SQL
    + """
    SELECT round(avg(CAST(pred IS DISTINCT FROM actual AS INT)) * 100, 6) AS mismatch_pct FROM decoded
    """,
)
def mismatch_percent(t: Tables) -> DataFrame:
    actual = F.concat(F.lit("NATION_"), F.col("label").cast("string"))
    rows = aggregates.mismatch_percent(_decoded(t).withColumn("actual", actual), "pred", "actual")
    return rows.select(F.round("mismatch_pct", 6).alias("mismatch_pct"))
