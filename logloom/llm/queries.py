"""The registered queries of the package: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.catalog.base import Tables
from logloom.llm import (
    byte_bpe,
    collocations,
    curve_search,
    filter_audit,
    language,
    lm_score,
    mixing,
    near_dedup,
    packing,
    quality,
    secret_scan,
    toxicity,
    warc,
)
from logloom.session import configure, work_dir

#: Rows in one Arrow batch: texts are whole, so a batch of the default size may outgrow a worker.
ROWS_PER_BATCH = 1000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def whole_texts(spark: SparkSession) -> SparkSession:
    """The session with the settings of the library and batches of few, long rows."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def query(function: Callable[[Tables], DataFrame]):
    """Register a function of the tables under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(Tables(whole_texts(spark), folder))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


@query
def op1_secret_scan(t: Tables) -> DataFrame:
    """Every candidate secret of the documents with the forest's verdict; values only as digests."""
    found = secret_scan.scan(t.documents, language.held_out("doc_id"))
    return found.select(
        "doc_id", "place", "run", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("value_chars"), "probability", "is_secret"
    )


@query
def op2_curve_search(t: Tables) -> DataFrame:
    """The 10 nearest vectors of every hundredth vector."""
    return curve_search.search(t.embeddings, F.col("vec_id") % 100 == 0)


@query
def op3_toxicity(t: Tables) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    return toxicity.classify(t.documents, toxicity.fit(t.documents, t.labels))


@query
def op4_lm_score(t: Tables) -> DataFrame:
    """Stupid-backoff score of every document under the counts of all documents, in runs of three words."""
    return lm_score.score(t.documents, order=3)


@query
def op5_language_id(t: Tables) -> DataFrame:
    """Language of every document by cross-parsing."""
    return language.identify(t.documents, language.fit(t.documents))


@query
def op6_quality_rules(t: Tables) -> DataFrame:
    """Base counts and likelihood-ratio verdict of every document; trusted are those of quality 1."""
    trusted = t.labels.where("quality = 1").select("doc_id")
    ratios = quality.log_ratios(quality.bucket_counts(t.documents, trusted))
    return quality.judge(t.documents, ratios)


@query
def op7_warc_archive(t: Tables) -> DataFrame:
    """The pages written to an archive and read back from it."""
    archive = warc.write_archive(t.pages, work_dir(t.spark, "warc"))
    return warc.parse_records(warc.read_archive(t.spark, archive)).drop("target_uri")


ORACLES["op7_warc_archive"] = warc.WARC_SQL.strip()


@query
def op8_source_mixing(t: Tables) -> DataFrame:
    """Words that a mix of the sources by weight 3, 1, 2 takes of every document."""
    return mixing.mix(t.documents)


ORACLES["op8_source_mixing"] = mixing.MIX_SQL.strip()


@query
def op9_byte_bpe(t: Tables) -> DataFrame:
    """Every document encoded and decoded again."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokenizer = byte_bpe.Tokenizer(t.spark, path, pattern)
    return byte_bpe.digests(tokenizer.round_trip(t.documents), tokenizer)


@query
def op10_minhash_near_dedup(t: Tables) -> DataFrame:
    """Groups of documents whose sets of two-word shingles share 80 % of their union."""
    return near_dedup.near_duplicates(t.documents, how=near_dedup.NearDedup(percent=80, shingle=2))


@query
def op11_filter_audit(t: Tables) -> DataFrame:
    """What every filter removes in each of the 120 orders, by language."""
    return filter_audit.audit(t.documents, t.labels)


ORACLES["op11_filter_audit"] = filter_audit.AUDIT_SQL.strip()


@query
def op12_phrase_collocations(t: Tables) -> DataFrame:
    """The 2,000 strongest phrases of two to five words per language."""
    return collocations.mine(t.documents)


ORACLES["op12_phrase_collocations"] = collocations.PHRASE_SQL.strip()


@query
def op13_packing(t: Tables) -> DataFrame:
    """All documents as token ids in sequences of 1,024."""
    return packing.pack(t.documents, public_tokenizers.path("byte_bpe_50k.json"))
