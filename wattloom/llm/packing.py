"""Cost-balanced packing of token pieces into sequences.

A document costs `linear * n + quadratic * n * n` to attend over. Whole sequences are cut off
long documents; what remains is assigned, longest first, to the cheapest sequence that still has
room. When nothing has room a piece is cut to fill what is left, so that every sequence is full;
the last tokens of a block go to sequences whose lengths are powers of two, which need no padding.
Blocks of at most `block` tokens (and one document) are packed on their own inside a partition:
no shuffle, and memory that doesn't grow with the input.
Defined results: null text is empty and gives one piece, its end mark; repeated rows and null ids
are packed like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import as_bytes, document_batches, partition_index
from wattloom.llm.word_tokens import MEMORY, chunk_ids

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
CAPACITY, END_ID = 4096, 2
BLOCK_TOKENS = 1 << 21
COST_LINEAR, COST_QUADRATIC = 1.0, 1.0 / 8192


def powers(n: int) -> list[int]:
    """The powers of two that sum to n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = COST_LINEAR, quadratic: float = COST_QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece of documents of these lengths."""
    cost = lambda n: linear * n + quadratic * n * n
    out, rest, n = [], [], 0
    for d, size in enumerate(lengths):
        whole = size // capacity
        for k in range(whole):
            out.append((d, k * capacity, capacity, n, 0))
            n += 1
        if size % capacity:
            rest.append((d, whole * capacity, size % capacity))
    rest.sort(key=lambda x: (-x[2], x[0]))
    m = sum(x[2] for x in rest) // capacity
    room, spent = np.full(m, capacity, np.int64), np.zeros(m)
    left = []

    def put(d: int, start: int, size: int, s: int) -> None:
        out.append((d, start, size, n + s, int(capacity - room[s])))
        room[s] -= size
        spent[s] += cost(size)

    for d, start, size in rest:
        fits = np.flatnonzero(room >= size)
        if len(fits):
            put(d, start, size, int(fits[np.argmin(spent[fits])]))
        else:
            left.append((d, start, size))
    open_ = [int(s) for s in np.argsort(spent, kind="stable") if room[s]][::-1]
    last = []
    for d, start, size in left:
        while size and open_:
            s = open_[-1]
            part = min(size, int(room[s]))
            put(d, start, part, s)
            start, size = start + part, size - part
            if not room[s]:
                open_.pop()
        if size:
            last.append((d, start, size))
    n += m
    sizes = powers(sum(x[2] for x in last))[::-1]
    offset = 0
    for d, start, size in last:
        while size:
            part = min(size, sizes[-1] - offset)
            out.append((d, start, part, n, offset))
            start, size, offset = start + part, size - part, offset + part
            if offset == sizes[-1]:
                sizes.pop()
                n, offset = n + 1, 0
    return out


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, block: int = BLOCK_TOKENS, memory: int = MEMORY) -> DataFrame:
    """One row for each piece of every document; memory bounds the chunks whose ids a worker remembers."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder, part = chunk_ids(tokenizer, memory), partition_index()
        held: list[tuple[int | None, bytes]] = []
        tokens = first = 0

        def close():
            nonlocal first
            sizes = [len(ids) // 4 for _, ids in held]
            pieces = pack(sizes, capacity)
            columns = list(zip(*((held[d][0], s, n, zlib.crc32(held[d][1][4 * s : 4 * (s + n)]), sizes[d], (part << 40) + first + q, o) for d, s, n, q, o in pieces)))
            first += 1 + max((p[3] for p in pieces), default=-1)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for b in batches:
            for doc, data in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                ids = encoder.ids(data) + end
                held.append((doc, ids))
                tokens += len(ids) // 4
                if tokens >= block:
                    yield close()
                    held, tokens = [], 0
        if held:
            yield close()

    document_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
