"""Chat formatting by columnar byte assembly.

A turn is written as

    <|im_start|>ROLE newline TEXT <|im_end|> newline

Inside roles and texts every backslash is doubled, and a backslash goes after the
first byte of any control string of this or other common templates (and, in roles,
for the newline), so no control string is left and removing the backslashes gives
the original.  A whole batch is assembled at once: segment lengths, cumulative offsets
and scatter indices are numpy arrays, headers and contents are copied into one
preallocated buffer, and the string column is made over that buffer.

Formatting needs no shuffle and keeps one row per turn, so a conversation with a
third of all turns is spread like any other rows.  A conversation's text is the
concatenation of its turns in order; its loss mask is the texts of the assistant.

Defined results: a null text or role is empty; a null conversation id is a
conversation of its own; turns with equal numbers (and repeated rows) follow in the
order of role and text, a null turn first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: This template's marks, then control strings of other templates.
START, END = b"<|im_start|>", b"<|im_end|>"
CONTROLS = (b"<|", b"<s>", b"</s>", b"[INST]", b"[/INST]", b"<<SYS>>", b"<</SYS>>", b"<start_of_turn>", b"<end_of_turn>")
SLASH = 0x5C


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and its offsets from 0; nulls are empty."""
    filled = column.fill_null("") if column.null_count else column
    filled = filled.cast(pa.large_string())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(filled) else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _escapes(raw: np.ndarray, offsets: np.ndarray, role: bool) -> np.ndarray:
    """Bytes before which a backslash goes, as 0/1 for every byte."""
    mark = np.zeros(len(raw), np.int64)
    mark[raw == SLASH] = 1
    if role:
        mark[raw == 0x0A] = 1
    for c in CONTROLS:
        at = np.flatnonzero(raw[: len(raw) - len(c) + 1] == c[0]) if len(raw) >= len(c) else np.zeros(0, np.int64)
        for k in range(1, len(c)):
            at = at[raw[at + k] == c[k]]
        if len(at):  # not across the border of two rows
            end = offsets[np.searchsorted(offsets, at, side="right")]
            mark[at[at + len(c) <= end] + 1] = 1
    return mark


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted turns, and where each text begins and ends in it (bytes)."""
    n = len(roles)
    parts = []
    for column, is_role in ((roles, True), (texts, False)):
        raw, at = _bytes_of(column)
        mark = _escapes(raw, at, is_role)
        shift = np.concatenate([[0], np.cumsum(mark)])  # backslashes before each byte
        parts.append((raw, at, mark, shift, at[1:] - at[:-1] + shift[at[1:]] - shift[at[:-1]]))
    role_len, text_len = parts[0][4], parts[1][4]
    lengths = len(START) + role_len + 1 + text_len + len(END) + 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    out = np.empty(offsets[-1], np.uint8)
    begins = (offsets[:-1] + len(START), offsets[:-1] + len(START) + role_len + 1)

    def constant(at: np.ndarray, value: bytes) -> None:
        out[at[:, None] + np.arange(len(value))] = np.frombuffer(value, np.uint8)

    if n:
        constant(offsets[:-1], START)
        constant(begins[1] - 1, b"\n")
        constant(begins[1] + text_len, END + b"\n")
    for (raw, at, mark, shift, _), begin in zip(parts, begins, strict=True):
        row = np.repeat(np.arange(n), np.diff(at))
        to = np.arange(len(raw)) + shift[1:] + (begin - at[:-1] - shift[at[:-1]])[row]
        out[to] = raw
        out[to[mark == 1] - 1] = SLASH
    strings = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out))
    return strings, begins[1] - offsets[:-1], begins[1] + text_len - offsets[:-1]


def format_turns(chats: DataFrame, rows: int = 2048) -> DataFrame:
    """``(conv_id, turn, role, formatted, text_start, text_end)``, a row per turn.

    ``text_start`` and ``text_end`` are byte places of the escaped text in ``formatted``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, rows):
                p = b.slice(k, rows)
                made, start, end = assemble(p.column(2), p.column(3))
                yield pa.RecordBatch.from_arrays(
                    [p.column(0), p.column(1), p.column(2), made.cast(pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["conv_id", "turn", "role", "formatted", "text_start", "text_end"],
                )

    slim = chats.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "conv_id long, turn long, role string, formatted string, text_start long, text_end long")


def unescape(raw: bytes) -> bytes:
    """Drop the backslash of every escaped byte."""
    import re

    return re.sub(rb"\\(.)", rb"\1", raw, flags=re.DOTALL)


def read_turn(formatted: bytes) -> tuple[bytes, bytes]:
    """Role and text of one formatted turn."""
    import re

    head = re.match(rb"<\|im_start\|>((?:[^\\\n]|\\.)*)\n", formatted, flags=re.DOTALL)
    if head is None or not formatted.endswith(b"<|im_end|>\n"):
        raise ValueError("not a formatted turn")
    return unescape(head[1]), unescape(formatted[head.end() : -len(b"<|im_end|>\n")])


def digests(turns: DataFrame) -> DataFrame:
    """Read formatted turns back and digest each conversation.

    Turns are dealt by conversation, sorted, and streamed through the hash one by
    one, so a task holds one batch however long a conversation is.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def closed(s: list) -> tuple:
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

        def made(done: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

        state = None
        for b in batches:
            done = []
            for conv, formatted in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist(), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(closed(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(formatted.encode())
                state[1] += 1
                state[2].update(role + b"\n" + text + b"\n")
                if role == b"assistant":
                    state[3] += len(text.decode())
                    state[4].update(text)
                state[5] += len(formatted)
            if done:
                yield made(done)
        if state is not None:
            yield made([closed(state)])

    # of one conversation, in order; equal turns by their formatted text (role, then text)
    dealt = turns.select("conv_id", "turn", "formatted").repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "formatted")
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.mapInArrow(run, kinds)
