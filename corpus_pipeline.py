"""From raw documents to tokens, in stages; each works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspan.llm import bpe, language_id, mixing, ngram_join, secret_scan
from ledgerspan.llm.common import shared_folder, table
from ledgerspan.llm.queries import RANK_FILE

#: A language must be told with this score: below it, or without a letter, a document goes.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; the others carry the language found."""
    return language_id.keep_identified(docs, language_id.learn(docs), LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked, examples that many owners copy stay; lengths follow the text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files ordered so that reading them gives every source its weight from the start."""
    mixed = mixing.mix(docs, slots=None).select("_row", "_position")
    return mixed.repartitionByRange("_position").sortWithinPartitions("_position").select("_row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with hashes of them and of the bytes they decode to."""
    return bpe.token_digest(docs, bpe.read_ranks(public_tokenizers.path(RANK_FILE)), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: Shingle joins and BPE are beyond SQL here; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
