"""Chat formatting: conversations rendered by a compiled template, with the spans to train on.

Turns of a conversation are sorted within one task and handed to the template one by one, so memory
is bounded by a turn and the next, however long a conversation is; a template goes through them once. Control strings inside texts are escaped by a backslash
after their first character; what looks escaped already gets one more, so it can be undone.
Defined results: null text or role is empty; turns are sorted by turn, role, text, nulls first;
repeated rows are turns of their own; rows without conv_id form one conversation with a null id;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import document_batches
from wattloom.llm.template import compile_template

PIECES = "conv_id long, place long, text string, spans array<struct<start:long,stop:long>>"
SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TEMPLATE = """
{%- for message in messages -%}
{{ '<|im_start|>' + (message.role | role) + '\\n' }}
{%- if message.role == 'assistant' -%}
{% generation %}{{ message.text | text }}{% endgeneration %}
{%- else -%}
{{ message.text | text }}
{%- endif -%}
{{ '<|im_end|>' + '\\n' }}
{%- endfor -%}
"""
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str | None) -> str:
    return _CONTROL.sub(r"<\\\1|", text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str | None) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


FILTERS = {"text": escape, "role": escape_role}


def read_back(pieces: Iterator[tuple[str, list[tuple[int, int]]]]) -> Iterator[tuple[str, str, str]]:
    """(role, text, text under the mask) of each turn of a formatted conversation, given in pieces."""
    held, spans, base = "", [], 0
    for text, marked in pieces:
        spans += [(base + a, base + b) for a, b in marked]
        held += text
        base += len(text)
        while (stop := held.find(CLOSE)) >= 0:
            if not held.startswith(OPEN):
                raise ValueError("a turn doesn't begin as it should")
            at = base - len(held)
            role, _, body = held[len(OPEN) : stop].partition("\n")
            end = at + stop + len(CLOSE)
            own, spans = [x for x in spans if x[0] < end], [x for x in spans if x[0] >= end]
            yield unescape_role(role), unescape(body), "".join(unescape(held[a - at : b - at]) for a, b in own)
            held = held[stop + len(CLOSE) :]
    if held:
        raise ValueError("the last turn isn't closed")


def _groups(batches, turn) -> Iterator[tuple]:
    """(key, iterator over turn(row)) of rows that come sorted by their first column."""
    from itertools import groupby

    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for key, own in groupby(rows, lambda r: r[0]):
        yield key, map(turn, own)


def _by_turn(render, turns: Iterator[dict]) -> Iterator[tuple[str, list[dict]]]:
    """(text, spans) of each turn of one rendered conversation. What stands before the turns goes with the first
    of them, what follows with the last."""
    taken, ended = 0, False

    def messages():
        nonlocal taken, ended
        for turn in turns:
            taken += 1
            yield turn
        ended = True

    text, spans, at, place = [], [], 0, 0
    for x, generated in render({"messages": messages()}):
        # While a turn is rendered, the template's loop has the next in hand, or knows that there is none.
        while place < (taken - 1 if ended else taken - 2):
            yield "".join(text), spans
            text, spans, at, place = [], [], 0, place + 1
        if generated:
            spans.append({"start": at, "stop": at + len(x)})
        text.append(x)
        at += len(x)
    yield "".join(text), spans
    yield from (("", []) for _ in range(place + 1, taken))


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """The formatted text in pieces, one for each turn, sorted by place within a conversation, which lies
    in one partition; `spans` are the generated stretches of a piece."""
    names = ["conv_id", "place", "text", "spans"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]

    def run(batches):
        render = compile_template(template, FILTERS)
        out: list[tuple] = []
        size = 0
        for key, own in _groups(batches, lambda r: {"role": r[1] or "", "text": r[2] or ""}):
            for place, (text, spans) in enumerate(_by_turn(render, own)):
                out.append((key, place, text, spans))
                size += len(text)
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    document_batches(turns.sparkSession)
    held = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return held.select("conv_id", "role", "text").mapInArrow(run, PIECES)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the pieces of each conversation hold when they are read back."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        out = []
        for key, own in _groups(batches, lambda r: (r[2], [(s["start"], s["stop"]) for s in r[3]])):
            turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, [0]

            def sized(pieces, size=size):
                for p in pieces:
                    size[0] += len(p[0])
                    yield p

            for role, text, marked in read_back(sized(own)):
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(marked.encode())
                n, chars = n + 1, chars + len(marked)
            out.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), size[0]))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return formatted.mapInArrow(run, SCHEMA)
