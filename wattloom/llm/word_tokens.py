"""Token ids of whole texts by a public word-level BPE, one encoding for each distinct chunk.

The tokenizer drops white space and never merges across it, so a text's ids are those of its
ASCII-space separated chunks in order. Lower-casing A-Z first changes nothing but the special
strings, which are case-sensitive: a text that might hold one stays as it is. A chunk that ends in
punctuation after an ASCII letter is two pieces to the tokenizer, so it is looked up in two parts.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

#: Chunks that a worker remembers (about 200 bytes each) unless told otherwise, and the longest of them in bytes.
MEMORY, LONGEST = 1_200_000, 64
#: Marks that neither begin a contraction nor belong to a special string.
_MARKS = b".,!?;:%&$*#"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")


def chunks_of(data: bytes) -> list[bytes]:
    return (data if b"<|" in data else data.lower()).split()


class ChunkIds(dict):
    """Chunk to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.memory = memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, chunks: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> None:
        tailed, parts = [], []
        for c in chunks:
            core = c.rstrip(_MARKS)
            if core and len(core) < len(c) and core[-1] in _LETTERS:
                tailed.append((c, core, c[len(core) :]))
            else:
                parts.append(c)
        parts = [c for c in {*parts, *(x for t in tailed for x in t[1:])} if c not in self]
        for c, ids in zip(parts, self.encode(parts)):
            self[c] = array("I", ids).tobytes()
        for c, core, tail in tailed:
            self[c] = self[core] + self[tail]

    def ids(self, data: bytes) -> bytes:
        chunks = chunks_of(data)
        if len(self) > self.memory:
            self.clear()
        missing = [c for c in set(chunks) if c not in self]
        if missing:
            self._learn(missing)
        out = b"".join(map(self.__getitem__, chunks))
        for c in missing:
            if len(c) > LONGEST:
                del self[c]
                self.pop(c.rstrip(_MARKS), None)
                self.pop(c[len(c.rstrip(_MARKS)) :], None)
        return out


@lru_cache(maxsize=1)
def chunk_ids(path: str, memory: int = MEMORY) -> ChunkIds:
    """A worker's encoder; what it has learnt serves the worker's later tasks too."""
    return ChunkIds(path, memory)
