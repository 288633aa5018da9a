"""Documents to packed sequences: quality rules, line dedup, MinHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. The first three
return the columns of docs; the last returns the pieces of packed sequences. ORACLE_SQL is None:
Viterbi decoding, MinHash and tokenisation have no SQL form, so tests hold the stages against brute
force on a small table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import line_dedup, minhash, packing, quality
from wattloom.llm.common import saved, table

ORACLE_SQL = None
#: Chunks that a packing worker remembers: fewer than by default, as an executor's heap has grown in the stages before.
REMEMBERED = 500_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line labels keep; the classifier is fitted on labelled documents."""
    return quality.quality_filter(docs, quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line is like; those that lose all their words go."""
    return line_dedup.dedup_lines(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first text of each group of near copies, by five-word shingles."""
    return minhash.without_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), memory=REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs)
    return docs
