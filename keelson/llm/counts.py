"""Token counts under a unigram model, by dynamic programming over a trie.

A text is split into pre-tokens (words, with the vocabulary's word mark before
them).  Distinct pre-tokens enter a trie; every trie node holds the best
segmentation (score and number of tokens) of the prefix it stands for, computed once
from the nodes above it, so words that share a prefix share the work, and a
word's terminal node holds its count.  Counts of terminals are kept by word; a
document's count is the sum over its words.

The model is a unigram model over a public vocabulary of pieces in rank order:
the probability of the piece of rank r is taken as proportional to 1 / (r + 1)
(Zipf's law), as the file has ranks and no frequencies.  A character outside the
vocabulary is spelled in its UTF-8 bytes.  Of equal scores the segmentation with
fewer tokens counts.

Scale: no shuffle; a task keeps one trie across its rows and starts a new one
at ``max_nodes``, which bounds memory and changes no count.  A word of more than
``LONG`` characters goes by a rolling window instead: the longest piece bounds how far a
segmentation looks back, so only that many prefixes are held.

Defined results: null, empty and blank texts count 0; rows are counted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary's word mark and the form of its byte pieces.
MARK = "▁"
BYTE = "<0x{:02X}>"
LONG = 4096


def load_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model in id order (read on the driver)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


def log_probabilities(pieces: list[str]) -> dict[str, float]:
    whole = log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -log(r + 1) - whole for r, p in enumerate(pieces)}


def piece_ends(scores: dict[str, float]) -> dict[str, float | None]:
    """Every end of every piece: the score if it is a piece itself, else None."""
    ends: dict[str, float | None] = {p[k:]: None for p in scores for k in range(len(p))}
    return ends | scores


@dataclass
class Trie:
    """Nodes are numbers; ``edges`` maps a node and a character to a node.

    At a node the last piece may be any end of the prefix; ends are tried from
    the shortest on, until no piece of the vocabulary ends so.
    """

    ends: dict[str, float | None]
    edges: dict[int, int] = field(default_factory=dict)
    best: list[float] = field(default_factory=lambda: [0.0])
    tokens: list[int] = field(default_factory=lambda: [0])

    def spelled(self, ch: str) -> tuple[float, int]:
        """Score and number of the byte pieces of a character."""
        raw = ch.encode("utf-8", "replace")
        found = [self.ends.get(BYTE.format(b)) for b in raw]
        return sum(-30.0 if s is None else s for s in found), len(raw)

    def insert(self, word: str) -> int:
        """Tokens of ``word``; prefixes seen before are not computed again."""
        node, path, edges = 0, [0], self.edges
        best, tokens, ends = self.best, self.tokens, self.ends
        for i, ch in enumerate(word, 1):
            key = node << 21 | ord(ch)
            nxt = edges.get(key)
            if nxt is None:
                s, n = ends.get(ch), 1
                if s is None:
                    s, n = self.spelled(ch)
                top, count = best[node] + s, tokens[node] + n
                for start in range(i - 2, -1, -1):
                    end = word[start:i]
                    s = ends.get(end)
                    if s is None:
                        if end not in ends:
                            break
                        continue
                    before = path[start]
                    s += best[before]
                    if s > top or (s == top and tokens[before] + 1 < count):
                        top, count = s, tokens[before] + 1
                nxt = edges[key] = len(best)
                best.append(top)
                tokens.append(count)
            node = nxt
            path.append(node)
        return tokens[node]


    def rolled(self, word: str) -> int:
        """Tokens of ``word`` without entering it: the last prefixes alone are kept."""
        ends, back = self.ends, max(map(len, self.ends))
        best, tokens, first = [0.0], [0], 0  # of the prefixes from ``first`` on
        for i, ch in enumerate(word, 1):
            s, n = ends.get(ch), 1
            if s is None:
                s, n = self.spelled(ch)
            top, count = best[-1] + s, tokens[-1] + n
            for start in range(i - 2, -1, -1):
                end = word[start:i]
                s = ends.get(end)
                if s is None:
                    if end not in ends:
                        break
                    continue
                s += best[start - first]
                if s > top or (s == top and tokens[start - first] + 1 < count):
                    top, count = s, tokens[start - first] + 1
            best.append(top)
            tokens.append(count)
            if len(best) > 64 * back:
                first += len(best) - back
                del best[:-back], tokens[:-back]
        return tokens[-1]


def count_tokens(docs: DataFrame, pieces: list[str], key: str = "doc_id", text: str = "text", max_nodes: int = 600_000) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` of every row."""
    ends = docs.sparkSession.sparkContext.broadcast(piece_ends(log_probabilities(pieces)))  # the vocabulary: its size is the parameter's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(ends.value), {}
        for b in batches:
            n_words, n_tokens = [], []
            for t in b.column(1):
                ws = (t.as_py() or "").encode("utf-8", "replace").split()
                total = 0
                for w in ws:
                    n = known.get(w)
                    if n is None and len(w) > LONG and len(w.decode()) > LONG:
                        n = trie.rolled(MARK + w.decode())
                    elif n is None:
                        if len(trie.best) > max_nodes:
                            trie, known = Trie(ends.value), {}
                        n = known[w] = trie.insert(MARK + w.decode())
                    total += n
                n_words.append(len(ws))
                n_tokens.append(total)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
