"""SentencePiece encoding and decoding over a table of distinct marked words.

The library marks white space: a blank becomes the mark, and a non-empty text gets
one mark in front.  Where no piece holds a mark after another character, no merge
ever crosses the border before a run of marks, so a marked text falls into chunks
(a run of marks and what follows it) that are segmented independently.  A task
keeps a table of distinct chunks: new ones are segmented by the library, once, and
all their occurrences take their ids from the table by position (numpy gather over
flat ids and offsets).  Decoding is the library's, a whole document at a time.

``chunkable`` checks what this rests on in the model file: byte-pair merges, no
normalisation but the marks, no user-defined symbols, no piece with a mark after
another character.  Any other model is encoded text by text instead.

Scale: no shuffle.  The table is kept for a worker's life and starts anew beyond
``TABLE`` chunks or ids, which changes no result.  (A table over the whole corpus
would need every occurrence of every word shuffled, several times the input.)  Long
texts are cut before a run of marks into windows of about ``WINDOW`` characters, so
the words of one window are held at a time; a chunk of more than ``LONG`` characters
is segmented by itself and not kept.

Defined results: a null text is empty and has no ids; null and repeated keys give a
row each; other columns are left out; ids that are null decode to the empty text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.tokenise import kept

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
EDGE = re.compile(f"(?<=[^{MARK}]){MARK}")
TABLE, LONG, WINDOW = 1 << 19, 1 << 12, 1 << 20


def load_model(path: str) -> bytes:
    """The model file, read on the driver (it travels with the job, under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def chunkable(model: bytes) -> bool:
    """Whether chunks of a marked text can be segmented one by one."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(model)
    n, kinds = m.normalizer_spec, pb.ModelProto.SentencePiece
    plain = n.add_dummy_prefix and n.escape_whitespaces and not n.remove_extra_whitespaces and not n.precompiled_charsmap
    merges = m.trainer_spec.model_type == pb.TrainerSpec.BPE and not m.trainer_spec.treat_whitespace_as_suffix
    own = any(p.type == kinds.USER_DEFINED for p in m.pieces)
    return bool(plain and merges and not own and not any(MARK in p.piece.lstrip(MARK) for p in m.pieces))


def windows(marked: str, size: int = 0) -> Iterator[str]:
    """A marked text in order, cut before runs of marks at about ``size`` characters."""
    at, size = 0, size or WINDOW
    while len(marked) - at > size:
        edge = EDGE.search(marked, at + size)
        if edge is None:
            break
        yield marked[at : edge.start()]
        at = edge.start()
    if at < len(marked):
        yield marked[at:]


def room(a: np.ndarray, n: int) -> np.ndarray:
    """``a``, doubled until it has ``n`` places."""
    while n > len(a):
        a = np.concatenate([a, np.zeros_like(a)])
    return a


class ChunkTable:
    """Distinct chunks and their ids, flat, in the order of arrival.

    A chunk of one mark and more is known by what follows the mark, any other by itself.
    """

    def __init__(self, sp, limit: int = TABLE) -> None:
        self.sp, self.limit, self.segmented = sp, limit, 0
        self.begins = np.array([p.startswith(MARK) for p in sp.id_to_piece(list(range(sp.get_piece_size())))])
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 12, np.int32)
        self.ends = np.zeros(1 << 12, np.int64)  # end of each chunk's ids, after a leading zero

    def one(self, chunk: str) -> np.ndarray:
        """Ids of a chunk of several marks or of a mark alone (the library puts the first itself)."""
        return np.array(self.sp.encode(chunk[1:], num_threads=1) if len(chunk) > 1 else [self.sp.piece_to_id(MARK)], np.int32)

    def add(self, new: list[str]) -> None:
        """Segment new chunks.  Plain words go to the library as one text, as of each the first
        piece, and no other, begins with the mark."""
        self.segmented += len(new)
        words, other = [c for c in new if c[0] != MARK], [c for c in new if c[0] == MARK]
        ids = np.array(self.sp.encode(" ".join(words), num_threads=1), np.int32)
        starts, each = np.flatnonzero(self.begins[ids]), [self.one(c) for c in other]
        lens = np.concatenate([np.diff(starts, append=len(ids)), np.array([len(x) for x in each], np.int64)])
        first = len(self.place)
        last = first + len(new)
        used = self.ends[first]
        ends = used + np.cumsum(lens)
        self.ids, self.ends = room(self.ids, ends[-1]), room(self.ends, last + 1)
        self.ids[used : ends[-1]] = np.concatenate([ids, *each])
        self.ends[first + 1 : last + 1] = ends
        self.place.update(zip(words + other, range(first, last), strict=True))

    def look_up(self, chunks: list[str]) -> np.ndarray:
        """Ids of the chunks, one after the other."""
        if max(len(self.place), self.ends[len(self.place)]) > self.limit:
            self.clear()
        new = set(chunks).difference(self.place)
        if new:
            self.add(list(new))
        at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        begin = self.ends[at]
        lens = self.ends[at + 1] - begin
        to = np.cumsum(lens)
        return self.ids[np.repeat(begin + lens - to, lens) + np.arange(to[-1] if len(to) else 0)]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.zeros(0, np.int32)
        if len(text) <= WINDOW and MARK not in text and "  " not in text and " " not in (text[0], text[-1]):
            words = text.split(" ")  # every chunk is one mark and a word
            if max(map(len, words)) < LONG:
                return self.look_up(words)
        out = []
        for w in windows(MARK + text.replace(" ", MARK)):
            chunks = [c[1:] if len(c) > 1 and c[1] != MARK else c for c in CHUNK.findall(w)]
            at = 0
            for k in (k for k, c in enumerate(chunks) if len(c) >= LONG) if len(w) > LONG else ():
                out += [self.look_up(chunks[at:k]), self.one(chunks[k] if chunks[k][0] == MARK else MARK + chunks[k])]
                at = k + 1
            out.append(self.look_up(chunks[at:]))
        return out[0] if len(out) == 1 else np.concatenate(out)


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids)`` of every row, ids as the library gives them without begin and end."""
    by_chunk = chunkable(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(f"chunks-{len(model)}", lambda: ChunkTable(processor(model)))
        whole = lambda t: np.array(table.sp.encode(t, num_threads=1) if t else [], np.int32)
        for b in batches:
            # several output batches for one of long texts
            made, held, first = [], 0, 0
            for k in range(b.num_rows):
                t = b.column(1)[k].as_py() or ""
                made.append(table.encode(t) if by_chunk else whole(t))
                held += len(made[-1])
                if held > 4 << 20 or k == b.num_rows - 1:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in made])])
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(made), pa.int32()))
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(made)), ids], [key, "ids"])
                    made, held, first = [], 0, k + 1

    slim = docs.select(F.col(key), F.col(text).cast("string"))
    return slim.mapInArrow(run, f"`{key}` {slim.dtypes[0][1]}, ids array<int>")


def decode(rows: DataFrame, model: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, ids, text)``: the library's text of each row's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = kept(f"pieces-{len(model)}", lambda: processor(model))
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                at, flat = part.column(1).offsets.to_numpy(), part.column(1).values.to_numpy(zero_copy_only=False)
                texts = [sp.decode(flat[x:y].tolist()) if y > x else "" for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [key, "ids", "text"])

    slim = rows.select(F.col(key), F.col(ids).cast("array<int>").alias("ids"))
    return slim.mapInArrow(run, f"`{key}` {slim.dtypes[0][1]}, ids array<int>, text string")
