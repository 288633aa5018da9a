"""Quality rules: a linear-chain CRF labels each line as content or boilerplate.

Viterbi decoding finds the best label sequence of a document's lines; the share of word
characters in content lines decides whether the document stays. Fixed base rules come first.
Defined results: null text counts as empty; a text without words fails the base rules; repeated
rows and null ids give one row each; an empty table gives no rows; other columns are ignored.
Labels are of documents: each line is taught its document's, and the chain learns how they follow each other. Labels
other than 0 and 1 are ignored; a document with both counts as 0. Without usable labels of both kinds the model has no
boilerplate evidence and the base rules decide alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import as_bytes, document_batches

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"
#: The classifier is fitted on at most so many labelled documents, on all lines of each.
MAX_LABELLED = 1200
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
CONTENT_SHARE = 0.5
EPOCHS, RATE, DECAY = 6, 0.2, 1e-4

SYMBOLS = "#*$%&|<>"
_SYMBOL_BYTES = SYMBOLS.encode() + b"!~^=_{}[]\\"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
#: Bin edges of the line features, in this order: words, mean word length, symbols a word, capitals a letter, digits a byte, distinct words.
EDGES = ((2, 5, 12, 40), (2.5, 3.5, 5, 7, 10, 16), (0.001, 0.1, 0.3, 0.6, 1.2), (0.02, 0.1, 0.25, 0.5, 0.8), (0.001, 0.05, 0.15, 0.4), (0.2, 0.35, 0.5, 0.7, 0.9))
_OFFSETS = tuple(np.cumsum([1] + [len(e) + 1 for e in EDGES]).tolist())
N_FEATURES = _OFFSETS[-1] + 4


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in some run of `window` words which the text holds at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed = (mixed ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    _, inverse, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    again = counts[inverse] >= 2
    if not again.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _bin(edges: tuple[float, ...], x: float) -> int:
    k = 0
    for e in edges:
        if x < e:
            break
        k += 1
    return k


def line_features(line: bytes, words: list[bytes], seen_before: bool, first: bool) -> list[int]:
    """Indices of a line's active features."""
    n, size = len(words), len(line)
    inked = sum(map(len, words))
    upper = size - len(line.translate(None, _UPPER))
    letters = upper + size - len(line.translate(None, _LOWER))
    values = (n, inked / n, (size - len(line.translate(None, _SYMBOL_BYTES))) / n, upper / max(letters, 1) if n > 3 else 0.0, (size - len(line.translate(None, _DIGITS))) / size, len(set(words)) / n if n > 5 else 1.0)
    found = [0] + [o + _bin(e, v) for o, e, v in zip(_OFFSETS, EDGES, values)]
    tail = _OFFSETS[-1]
    if words[-1][-1:] in (b".", b"!", b"?"):
        found.append(tail)
    if seen_before:
        found.append(tail + 1)
    if first:
        found.append(tail + 2)
    if n <= 2:
        found.append(tail + 3)
    return found


def sequence(data: bytes) -> tuple[list[list[int]], list[int], int]:
    """Feature lists and word bytes of the lines that hold a word, and the number of repeated lines."""
    features, sizes, seen, repeats = [], [], set(), 0
    for line in data.split(b"\n"):
        words = line.split()
        if not words:
            continue
        again = line in seen
        repeats += again
        seen.add(line)
        features.append(line_features(line, words, again, not features))
        sizes.append(sum(map(len, words)))
    return features, sizes, repeats


class LineCrf:
    """Two labels; `emit` scores boilerplate against content, `move[a][b]` scores label b after a."""

    def __init__(self, emit=None, move=None):
        self.emit = [0.0] * N_FEATURES if emit is None else emit
        self.move = [[0.0, 0.0], [0.0, 0.0]] if move is None else move

    def viterbi(self, features: list[list[int]]) -> list[int]:
        """Label of each line, 1 for boilerplate; ties go to content."""
        emit, move = self.emit, self.move
        best, back = [0.0, 0.0], []
        for t, active in enumerate(features):
            score = sum(emit[i] for i in active)
            if t == 0:
                best = [0.0, score]
                continue
            a0, a1 = best[0] + move[0][0], best[1] + move[1][0]
            b0, b1 = best[0] + move[0][1], best[1] + move[1][1]
            back.append((0 if a0 >= a1 else 1, 0 if b0 >= b1 else 1))
            best = [max(a0, a1), max(b0, b1) + score]
        if not features:
            return []
        labels = [0 if best[0] >= best[1] else 1]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]

    def learn(self, features: list[list[int]], label: int, rate: float) -> None:
        """One gradient step of the log-likelihood of a sequence whose lines all carry `label`."""
        n, move = len(features), self.move
        score = [sum(self.emit[i] for i in active) for active in features]
        both = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y)))
        ahead = [(0.0, score[0])]
        for t in range(1, n):
            p = ahead[-1]
            ahead.append((both(p[0] + move[0][0], p[1] + move[1][0]), both(p[0] + move[0][1], p[1] + move[1][1]) + score[t]))
        behind = [(0.0, 0.0)] * n
        for t in range(n - 2, -1, -1):
            q, s = behind[t + 1], score[t + 1]
            behind[t] = (both(move[0][0] + q[0], move[0][1] + s + q[1]), both(move[1][0] + q[0], move[1][1] + s + q[1]))
        total = both(*ahead[-1])
        step = rate / n
        for t, active in enumerate(features):
            p1 = math.exp(ahead[t][1] + behind[t][1] - total)
            for i in active:
                self.emit[i] += step * (label - p1)
        if n > 1:
            for a in (0, 1):
                for b in (0, 1):
                    expected = sum(math.exp(ahead[t - 1][a] + move[a][b] + b * score[t] + behind[t][b] - total) for t in range(1, n))
                    move[a][b] += step * ((n - 1) * (a == label == b) - expected)


def train(examples: list[tuple[list[list[int]], int]]) -> LineCrf:
    """Stochastic gradient over whole-document sequences; the classes weigh alike."""
    crf, n = LineCrf(), [sum(1 for _, y in examples if y == k) for k in (0, 1)]
    if min(n) < 3:
        return crf
    order = np.random.default_rng(7)
    for epoch in range(EPOCHS):
        for k in order.permutation(len(examples)):
            features, label = examples[k]
            crf.learn(features, label, RATE / (1 + epoch) * min(4.0, len(examples) / (2 * n[label])) * min(len(features), 12))
        crf.emit = [w * (1 - DECAY) for w in crf.emit]
    return crf


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> LineCrf:
    """Fit on at most `most` labelled documents: those whose ids have the smallest hashes."""
    chosen = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    quality = {r["doc_id"]: r["quality"] for r in chosen}
    if len(set(quality.values())) < 2:
        return LineCrf()

    def features(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sequence(x)[0] for x in as_bytes(b.column(1))], pa.list_(pa.list_(pa.int32())))], ["doc_id", "features"])

    document_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isin(list(quality))).mapInArrow(features, "doc_id long, features array<array<int>>").collect()
    examples = [([list(f) for f in r["features"]], 1 - quality[r["doc_id"]]) for r in sorted(rows, key=lambda r: (r["doc_id"], str(r["features"]))) if r["features"]]
    return train(examples)


def assess(data: bytes, crf: LineCrf) -> tuple:
    """The figures and the verdict of one text."""
    words = data.split()
    text = data.decode("utf-8", "replace")
    n, chars = len(words), len(text) - sum(map(text.count, " \t\n\r\v\f"))
    symbols = sum(map(data.count, (c.encode() for c in SYMBOLS)))
    repeats = repeated_words(words)
    features, sizes, dup_lines = sequence(data)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    content = sum(s for s, y in zip(sizes, crf.viterbi(features)) if y == 0)
    share = content / sum(sizes) if sizes else 0.0
    return n, chars, symbols, dup_lines, repeats, failed, not failed and share >= CONTENT_SHARE, share


def quality_report(docs: DataFrame, crf: LineCrf) -> DataFrame:
    """Figures and verdict of every document."""
    emit, move = crf.emit, crf.move

    def run(batches):
        model = LineCrf(emit, move)
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for b in batches:
            rows = [assess(x, model) for x in as_bytes(b.column(1))]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    document_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def quality_filter(docs: DataFrame, crf: LineCrf) -> DataFrame:
    """The rows of docs, with all their columns, whose text is kept."""
    emit, move = crf.emit, crf.move

    def run(batches):
        model = LineCrf(emit, move)
        for b in batches:
            yield b.filter(pa.array([assess(x, model)[6] for x in as_bytes(b.column("text"))], pa.bool_()))

    document_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
