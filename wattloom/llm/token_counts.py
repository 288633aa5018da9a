"""Token counts: each distinct pre-token is tokenised once, and counts meet frequencies in a join.

1. Workers count pre-tokens; a sum over all of them gives the distinct ones with their frequency.
2. Each distinct pre-token is tokenised once.
3. Each document's pre-token frequencies meet the counts: those of the `frequent` most frequent
   pre-tokens (a fixed bound) through a broadcast, all others through a shuffle join, where by
   that choice no key is hot. Sums by document end it; no ids are materialised.
A pre-token is a chunk between ASCII white space, in lower case, with a final full stop or comma
split off after an ASCII letter: the tokenizer never merges across either boundary.
Defined results: null text is empty with 0 tokens; repeated rows and null ids give one row each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import as_bytes, document_batches, partition_index, saved
from wattloom.llm.word_tokens import chunk_ids, chunks_of

#: Pre-tokens whose counts are broadcast, and the longest of them in bytes: at most 16 MB of text.
FREQUENT, FREQUENT_BYTES = 1 << 18, 64
LIMIT = 2048
_LETTERS = frozenset(range(97, 123)) | frozenset(range(65, 91))


def frequencies(data: bytes) -> dict[bytes, int]:
    """Pre-tokens of a text and how often each stands there."""
    out = Counter(chunks_of(data))
    for c in [c for c in out if c[-1] in b".," and len(c) > 1]:
        if c[-2] in _LETTERS:
            n = out.pop(c)
            out[c[:-1]] += n
            out[c[-1:]] += n
    return out


def distinct_pretokens(docs: DataFrame) -> DataFrame:
    """token binary, n long: all pre-tokens of the corpus and their frequency."""

    def run(batches):
        held = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["token", "n"])

        for b in batches:
            for x in as_bytes(b.column(0)):
                held.update(frequencies(x))
            if len(held) > 300_000:
                yield flush()
                held.clear()
        yield flush()

    document_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def counted_pretokens(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """token, n and the pieces that one such pre-token becomes."""

    def run(batches):
        encoder = chunk_ids(tokenizer)
        for b in batches:
            pieces = [len(ids) for ids in encoder.encode(b.column(0).to_pylist())] if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pieces, pa.int64())], ["token", "n", "pieces"])

    return tokens.mapInArrow(run, "token binary, n long, pieces long")


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    spark = docs.sparkSession
    counted = saved(counted_pretokens(distinct_pretokens(docs), tokenizer))
    top = counted.where(F.length("token") <= FREQUENT_BYTES).orderBy(F.desc("n"), "token").select("token", "pieces").limit(frequent).toArrow()
    known = spark.sparkContext.broadcast(dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist())))

    def run(batches):
        pieces, row = known.value, partition_index() << 40
        for b in batches:
            rows, ids, sizes, sums = [], [], [], []
            at, rare, times = [], [], []
            for doc, data in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                row, total = row + 1, 0
                for token, n in frequencies(data).items():
                    k = pieces.get(token)
                    if k is None:
                        at.append(row)
                        rare.append(token)
                        times.append(n)
                    else:
                        total += n * k
                rows.append(row)
                ids.append(doc)
                sizes.append(len(data))
                sums.append(total)
            none = pa.nulls(len(rows), pa.int64())
            # A document's own row has a key that no pre-token equals, as it begins with a space.
            keys = pa.array([b" %d" % r for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), keys, pa.array(sums, pa.int64())], names)
            if rare:
                none = pa.nulls(len(rare), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), none, none, pa.array(rare, pa.binary()), pa.array(times, pa.int64())], names)

    names = ["row", "doc_id", "n_bytes", "token", "times"]
    document_batches(spark)
    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "row long, doc_id long, n_bytes long, token binary, times long")
    joined = parts.join(counted.select("token", "pieces"), "token", "left")
    own = F.col("n_bytes").isNotNull()
    summed = joined.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(F.when(own, F.col("times")).otherwise(F.col("times") * F.col("pieces"))).alias("n_tokens"))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
