"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import byte_bpe, chat_format, embedding_dedup, html_extract, license_scan, line_dedup, minhash, packing, quality, token_counts
from wattloom.llm.common import table

#: A user and an assistant that both say control strings, added to the conversations.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_links(table(spark, sf_dir, "embeddings"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    return chat_format.conversation_digests(chat_format.format_conversations(turns.unionByName(planted)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_report(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_license_scan, op3_line_dedup, op4_token_counts, op5_embedding_near_dedup, op6_byte_bpe, op7_chat_formatting, op8_packing, op9_minhash_near_dedup, op10_quality_rules)}
#: None of these results can be written in SQL; tests hold them against brute force.
ORACLES: dict[str, str] = {}
