"""Byte-pair token ids in tasks, from a public vocabulary file.

The file is read once on the driver and travels with the job (under 2 MB), so
executors need no path.  A parsed vocabulary is kept for the worker's life.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The vocabulary's own split pattern and its one special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}
#: The pattern's white space; its engine keeps a state per character of a run and fails
#: beyond a million, so runs of so many characters are encoded by themselves.
LONG = 1 << 16
LONG_RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG},}}")


def kept(name: str, make):
    """``make()`` once in a worker's life."""
    cache = sys.__dict__.setdefault("_keelson_kept", {})
    if name not in cache:
        cache[name] = make()
    return cache[name]


def encoder(ranks: bytes):
    """A tokenizer of the byte-level vocabulary in ``ranks`` (token, rank lines)."""
    import base64

    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=table, special_tokens=SPECIAL)


def token_ids(enc, text: str | None, end: int = 0) -> np.ndarray:
    """Ids of a whole text, then ``end``; the special token's string is that token."""
    t = (text or "").encode("utf-8", "replace").decode()
    parts, at = [], 0
    for m in LONG_RUN.finditer(t) if len(t) >= LONG else ():
        # a run is one pre-token, but for its last character where other text follows
        over = m.end() == len(t) or t.startswith(tuple(SPECIAL), m.end())
        stop = m.end() if over else m.end() - 1
        parts += [enc.encode_to_numpy(t[at : m.start()], allowed_special="all"), np.array(enc._encode_single_piece(t[m.start() : stop]), np.uint32)]
        at = stop
    return np.concatenate([*parts, enc.encode_to_numpy(t[at:], allowed_special="all"), np.array([end], np.uint32)])


def encode_batches(ranks: bytes, width: str, end: int = 0, rows: int = 256):
    """A ``mapInArrow`` function: the last column is text, replaced by ``n`` and ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = kept(f"bpe-{len(ranks)}", lambda: encoder(ranks))
        for b in batches:
            for k in range(0, b.num_rows, rows):
                part = b.slice(k, rows)
                ids = [token_ids(enc, t.as_py(), end) for t in part.column(part.num_columns - 1)]
                n = pa.array([len(x) for x in ids], pa.int64())
                raw = pa.array([x.astype(width).tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], n, raw], [*part.schema.names[:-1], "n", "ids"])

    return run
