"""Byte-level BPE by sentencepiece: a model made from the ranks alone, nothing trained.

Every byte stands for one letter, a token for the letters of its bytes, scored by its negative
rank, so that the merge of the best score is the merge of the lowest rank. Pre-tokens are encoded
one by one and remembered; ids are decoded through the inverse mapping.
Defined results: null text is empty and has no tokens; repeated rows and null ids give one row
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import document_batches

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
MEMORY, LONGEST = 500_000, 64
#: The letter of byte b: code points from U+0100 on, which no normaliser or white-space rule touches here.
LETTERS = [chr(0x100 + b) for b in range(256)]
UNKNOWN = "\ue000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One protobuf field: text or bytes, a float, or a whole number."""
    if isinstance(value, str):
        value = value.encode()
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; ids are the ranks, the unknown piece comes last."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    out = [_field(1, _field(1, "".join(LETTERS[b] for b in t)) + _field(2, -float(i)) + _field(3, 1)) for i, t in enumerate(tokens)]
    out.append(_field(1, _field(1, UNKNOWN) + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(k, (1 << 64) - 1) for k in (41, 42, 43)) + _field(45, UNKNOWN)
    normaliser = _field(1, "identity") + b"".join(_field(k, 0) for k in (3, 4, 5))
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.ranks))
        self.split = regex.compile(pattern).findall
        back = {c: b for b, c in enumerate(LETTERS)}
        self.bytes_of = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(self.ranks))]

    def encode(self, text: str) -> array:
        pieces = self.split(text)
        if len(self) > MEMORY:
            self.clear()
        missing = [p for p in set(pieces) if p not in self]
        slow = []
        for p in missing:
            rank = self.ranks.get(p.encode())
            if rank is None:
                slow.append(p)
            else:
                self[p] = array("I", [rank]).tobytes()
        if slow:
            for p, ids in zip(slow, self.model.encode(["".join([LETTERS[b] for b in p.encode()]) for p in slow], num_threads=1)):
                self[p] = array("I", ids).tobytes()
        out = array("I", b"".join(map(self.__getitem__, pieces)))
        for p in slow:
            if len(p) > LONGEST:
                del self[p]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """A worker's model; what it has learnt serves the worker's later tasks too."""
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, the ids of the whole text, and what they decode to."""

    def run(batches):
        bpe = byte_bpe(ranks, pattern)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = bpe.encode(text or "")
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64())), pa.array([bpe.decode(ids)], pa.binary())], ["doc_id", "ids", "decoded"])

    document_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<long>, decoded binary")


def encode_digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes, made where the ids are."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        bpe = byte_bpe(ranks, pattern)
        for b in batches:
            sizes, sums, backs = [], [], []
            for text in b.column(1).to_pylist():
                ids = bpe.encode(text or "")
                sizes.append(len(ids))
                sums.append(hashlib.sha256(ids.tobytes()).hexdigest())
                backs.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(sums), pa.array(backs)], names)

    document_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)
