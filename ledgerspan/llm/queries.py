"""The operators over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspan.llm import (
    bpe,
    chat_format,
    conversation_repair,
    embedding_dedup,
    filter_audit,
    language_id,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    secret_scan,
    token_counts,
    toxicity,
)
from ledgerspan.llm.common import table
from ledgerspan.llm.oracle import ORACLE_SQL

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
PACKED_VOCABULARY = "byte_bpe_50k.json"
#: A conversation whose texts look like a template's control strings.
ODD_TURN, ODD_ID = "\\### Assistant: </turn> ok", -7


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a repository, its source the owner."""
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_block").alias("block"),
        F.col("_slot").alias("slot"),
        F.col("_position").alias("position"),
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    return bpe.token_digest(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a turn each, and a conversation in the messages layout."""
    by_turn = table(spark, sf_dir, "conversations").select(
        F.to_variant_object(F.struct("conv_id", "turn", "role", "text")).alias("record")
    )
    messages = F.array(*(F.struct(F.lit(role).alias("role"), F.lit(ODD_TURN).alias("content")) for role in ("user", "assistant")))
    odd = spark.range(1).select(
        F.to_variant_object(F.struct(F.lit(ODD_ID).cast("bigint").alias("conv_id"), messages.alias("messages"))).alias("record")
    )
    return chat_format.format_digest(by_turn.unionByName(odd))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), token_counts.rank_pieces(ranks), public_tokenizers.PATTERN
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_digest(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = packing.read_tokenizer(public_tokenizers.path(PACKED_VOCABULARY))
    pieces = packing.pack(table(spark, sf_dir, "documents"), spec)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mixing": op2_mixing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_join": op5_ngram_join,
    "op6_bpe": op6_bpe,
    "op7_chat_format": op7_chat_format,
    "op8_token_counts": op8_token_counts,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_packing": op13_packing,
}
__all__ = ["ORACLE_SQL", "QUERIES"]
