"""A training-corpus pipeline: five stages over the documents, each rereading what the last one wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logloom.llm import byte_bpe, language, mixing, near_dedup, secret_scan
from logloom.llm.queries import whole_texts
from logloom.session import work_dir

#: Stages without an SQL form: language models, signatures, a forest and an encoder.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fill in the language where it is null; documents without a letter (and null texts) go.

    Texts with a letter all stay, also where no label was there to learn from (their
    language then stays null). Null ids and repeated rows are kept row by row.
    """
    whole_texts(spark)
    return language.label(docs, language.fit(docs))


def near_dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five-word shingles, 0.8): that with the smallest id.

    A document is an id and its text: an id with two texts is two documents, equal rows
    are one. Documents without an id take part behind all others.
    """
    whole_texts(spark)
    return near_dedup.drop_near_duplicates(docs, how=near_dedup.NearDedup(percent=80, shingle=5))


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets that the forest confirms; every document stays."""
    whole_texts(spark)
    return secret_scan.redact(docs, secret_scan.scan(docs, language.held_out("doc_id")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one at a source's cut stays whole.

    Rows with null or repeated ids and a null source take part like all others.
    """
    whole_texts(spark)
    return mixing.mixed_copies(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every row, null and repeated ids included."""
    whole_texts(spark)
    tokenizer = byte_bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.digests(tokenizer.round_trip(docs), tokenizer)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup_documents),
    ("secret_scan", scan_secrets),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = whole_texts(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = work_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
