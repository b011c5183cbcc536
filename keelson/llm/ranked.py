"""Ranked lexical search: norm buckets with Cauchy-Schwarz and coordinate bounds.

Terms are maximal runs of ASCII letters and digits and of everything beyond ASCII,
A-Z lower-cased.  A document's impact for a term is

    w * ((1000000000 * tf) div (1000 * tf + 8 * m)),   m = 25 + ((75 * n * N) div L)

with the term's weight w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))); its score for
an item is the inner product of its impact vector with the item's term counts.  The
search follows the large-entry retrieval scheme of norm buckets:

1. impact vectors (over the items' terms only) are ordered by length and written so:
   a task reads a few length ranges, in buckets of ``BUCKET`` vectors;
2. the longest vectors of all (``PILOT``) are searched first; their k-th best score is
   a lower bound of each item's final one, so vectors shorter than any item's bound
   over its own length are not even read (a filter on the stored length), and a bucket
   is skipped for an item where |item| * |longest of the bucket| is below the bound;
3. inside a bucket the item's weightiest terms (``FOCUS``) are looked up in the
   bucket's inverted lists, and what the other coordinates can add is bounded by
   Cauchy-Schwarz on the remaining lengths; vectors below the bound are out;
4. survivors are scored exactly, in 64-bit integers, and the bound rises.

Bounds are compared with a margin far above rounding, and only strictly lower ones
prune, so results are exact, ties included.

Items are a query set: they are read in blocks of at most ``ITEMS`` rows and
``ITEM_BYTES`` of text (or one item), each searched in all documents.  Scale: texts
are read once a block and reduced to (term, count) lists; only vectors are shuffled,
by length and a salt, so equal lengths spread; a task holds a bucket and k rows an
item; the driver holds a block of items, its terms' document counts and bounds.

Defined results: a null or term-free text (document or item) matches nothing; a null
doc_id ranks after equal scores with one; repeated documents rank each, repeated items
are answered each; items without a match give no row.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import store

ITEMS, ITEM_BYTES = 1024, 4 << 20
BUCKET, PILOT, FOCUS, PIECE = 1024, 4096, 6, 1 << 20
MARGIN = 1 - 1e-9
#: Every ASCII byte but letters and digits parts terms; A-Z are lower-cased.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def folded(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in order, by pieces of about ``PIECE`` bytes cut between terms."""
    at = 0
    while at < len(raw):
        part = raw[at : at + PIECE].translate(FOLD)
        cut = len(part) if at + PIECE >= len(raw) else part.rfind(b" ") + 1
        if cut == 0:  # a term of more than a piece
            rest = raw[at:].translate(FOLD)
            end = rest.find(b" ")
            cut = len(rest) if end < 0 else end
            part = rest
        yield part[:cut].split()
        at += cut


def count_terms(raw: bytes | None, place: dict) -> tuple[int, Counter]:
    """Number of all terms, and occurrences of those in ``place`` by their place."""
    n, found = 0, Counter()
    for part in folded(raw or b""):
        n += len(part)
        found.update(map(place.get, part))
    del found[None]
    return n, found


class Items:
    """A block of items: distinct terms, and each item's terms with their counts."""

    def __init__(self, rows: list[tuple], first: int = 0) -> None:
        self.first, self.place = first, {}
        self.ids = [i for i, _ in rows]
        self.terms = []
        for _, raw in rows:
            count = Counter(t for part in folded(raw or b"") for t in part)
            self.terms.append({self.place.setdefault(t, len(self.place)): n for t, n in count.items()})


def blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """The items in blocks; the driver holds one (and a partition being read)."""
    rows, size, first = [], 0, 0
    for r in items.select(F.col(key).cast("long"), F.col(text).cast("binary")).toLocalIterator():
        raw = bytes(r[1] or b"")
        if rows and (len(rows) >= ITEMS or size + len(raw) > ITEM_BYTES):
            yield Items(rows, first)
            rows, size, first = [], 0, first + len(rows)
        rows.append((r[0], raw))
        size += len(raw)
    if rows:
        yield Items(rows, first)


def postings(docs: DataFrame, items: Items, key: str, text: str) -> DataFrame:
    """``(key, n, terms, tfs)`` of documents with a term: n of all terms, lists of the items'."""
    place = items.place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ns, flat, tfs, ends = [], [], [], [], [0]
            for k in range(b.num_rows):
                n, found = count_terms(b.column(1)[k].as_py(), place)
                if n:
                    ids.append(b.column(0)[k].as_py())
                    ns.append(n)
                    flat.extend(found.keys())
                    tfs.extend(found.values())
                    ends.append(len(flat))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (flat, tfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), *lists], ["key", "n", "terms", "tfs"])

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary"))
    return slim.mapInArrow(run, "key long, n long, terms array<int>, tfs array<int>")


def flat_lists(b: pa.RecordBatch, *names: str) -> tuple[np.ndarray, ...]:
    """Offsets from 0 and flat values of list columns of equal lengths."""
    first = b.column(names[0])
    at = first.offsets.to_numpy()
    return (at - at[0], *(b.column(n).flatten().to_numpy(zero_copy_only=False) for n in names))


def impact_vectors(found: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """``(key, norm, terms, impacts)`` of documents with a positive impact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, terms, tf = flat_lists(b, "terms", "tfs")
            tf = tf.astype(np.int64)
            m = np.repeat(b.column("m").to_numpy(), np.diff(at))
            impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            row = np.repeat(np.arange(b.num_rows), np.diff(at))
            has = impact > 0
            norm = np.sqrt(np.bincount(row[has], impact[has].astype(np.float64) ** 2, b.num_rows))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[has], minlength=b.num_rows))])
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x) for x in (pa.array(terms[has], pa.int32()), pa.array(impact[has], pa.int64()))]
            out = pa.RecordBatch.from_arrays([b.column("key"), pa.array(norm), *lists], ["key", "norm", "terms", "impacts"])
            yield out.filter(pa.array(norm > 0))

    m = F.expr(f"100 - 75 + ((75 * n * {n_docs}L) div {n_terms}L)").cast("long").alias("m")
    slim = found.where(F.size("terms") > 0).select("key", m, "terms", "tfs")
    return slim.mapInArrow(run, "key long, norm double, terms array<int>, impacts array<long>")


class Search:
    """The best k rows of every item of a block among the vectors seen so far."""

    def __init__(self, items: list[dict], weights: np.ndarray, bounds: list[int], k: int) -> None:
        self.k, self.size, self.bounds = k, len(weights), list(bounds)
        self.best: list[list[tuple]] = [[] for _ in items]
        self.queries = []
        for terms in items:
            order = sorted((t for t in terms if weights[t] > 0), key=lambda t: (-weights[t], t))
            counts = [terms[t] for t in order]
            rest = sum(c * c for c in counts[FOCUS:])
            self.queries.append((order, counts, math.sqrt(sum(c * c for c in counts)), math.sqrt(rest)))
        self.tried = self.scored = 0  # vectors that met an item's bucket, and those scored in full

    def bucket(self, keys: list, norm: np.ndarray, at: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        longest = norm.max()
        live = [q for q, (order, _, length, _) in enumerate(self.queries) if order and length * longest >= self.bounds[q] * MARGIN]
        if not live:
            return
        # inverted lists of the bucket
        by_term = np.argsort(terms, kind="stable")
        row = np.repeat(np.arange(len(norm)), np.diff(at))[by_term]
        impact = impacts[by_term]
        ends = np.searchsorted(terms[by_term], np.arange(self.size + 1))
        square = norm * norm
        for q in live:
            order, counts, _, rest = self.queries[q]
            score, seen = np.zeros(len(norm), np.int64), np.zeros(len(norm))
            for t, c in zip(order[:FOCUS], counts[:FOCUS], strict=True):
                s = slice(ends[t], ends[t + 1])
                score[row[s]] += c * impact[s]
                seen[row[s]] += impact[s].astype(np.float64) ** 2
            most = score + rest * np.sqrt(np.maximum(square - seen, 0))
            alive = most >= max(self.bounds[q], 1) * MARGIN
            self.tried += len(norm)
            if not alive.any():
                continue
            self.scored += int(alive.sum())
            for t, c in zip(order[FOCUS:], counts[FOCUS:], strict=True):
                s = slice(ends[t], ends[t + 1])
                score[row[s]] += c * impact[s]
            self.offer(q, keys, score, np.flatnonzero(alive & (score >= max(self.bounds[q], 1))))

    def offer(self, q: int, keys: list, score: np.ndarray, at: np.ndarray) -> None:
        if len(at) > 4 * self.k:  # more than can stay: all down to the k-th score
            at = at[score[at] >= np.partition(score[at], -self.k)[-self.k]]
        # by score, then keys ascending, a null one last
        rows = ((int(score[i]), keys[i] is not None, -(keys[i] or 0)) for i in at)
        self.best[q] = heapq.nlargest(self.k, [*self.best[q], *rows])
        if len(self.best[q]) == self.k:
            self.bounds[q] = max(self.bounds[q], self.best[q][-1][0])


def search(vectors: DataFrame, items: Items, weights: np.ndarray, bounds: list[int], k: int) -> DataFrame:
    """``(q, item_id, doc_id, score)``: every task's best k rows of each item, at least its bound."""
    terms, ids, first = items.terms, items.ids, items.first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Search(terms, weights, bounds, k)
        for b in batches:
            for at in range(0, b.num_rows, BUCKET):
                part = b.slice(at, BUCKET)
                s.bucket(part.column("key").to_pylist(), part.column("norm").to_numpy(), *flat_lists(part, "terms", "impacts"))
        out = [(first + q, ids[q], -key if has else None, score) for q, rows in enumerate(s.best) for score, has, key in rows]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.int64()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["q", "item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "q long, item_id long, doc_id long, score long")


def term_weights(found: DataFrame, n_docs: int, size: int) -> np.ndarray:
    """Weights of a block's terms; 0 where no document holds the term."""
    out = np.zeros(size, np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term of the block
        out[r.t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    return out


def pilot_length(vectors: DataFrame) -> float:
    """A length that about ``PILOT`` vectors reach (more where many are equally long),
    from counts by the length's logarithm in 16ths: a few hundred rows to the driver."""
    steps = vectors.groupBy(F.floor(F.log2("norm") * 16).alias("step")).count().orderBy(F.col("step").desc()).collect()
    n = 0
    for r in steps:
        n += r["count"]
        if n >= PILOT:
            return 2.0 ** (r.step / 16) * MARGIN
    return 0.0


def best(rows: DataFrame, k: int) -> DataFrame:
    """The tasks' rows with ``rank``, k an item; ranked in parts first, as tasks may be many."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("q", "part").orderBy(*order)
    some = rows.withColumn("part", F.spark_partition_id() % 64).withColumn("r", F.row_number().over(part)).where(F.col("r") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for items in blocks(queries, item_id, text):
        found = store(postings(docs, items, doc_id, text), "ranked-postings")
        total = found.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_terms")).first()
        if not total.n_docs:
            continue
        weights = term_weights(found, total.n_docs, len(items.place))
        # equal lengths (copies of a document) are spread over tasks by a salt
        made = impact_vectors(found, weights, total.n_docs, total.n_terms).withColumn("salt", F.rand(7))
        ordered = made.repartitionByRange(F.col("norm").desc(), F.col("salt")).sortWithinPartitions(F.col("norm").desc()).drop("salt")
        vectors = store(ordered, "ranked-vectors")
        bounds = [0] * len(items.ids)
        longest = vectors.where(F.col("norm") >= pilot_length(vectors))
        for r in best(search(longest, items, weights, bounds, k), k).where(F.col("rank") == k).collect():  # a row an item
            bounds[r.q - items.first] = r.score
        lengths = [math.sqrt(sum(c * c for t, c in terms.items() if weights[t] > 0)) for terms in items.terms]
        shortest = min((b / x for b, x in zip(bounds, lengths, strict=True) if x), default=0.0)
        rows = search(vectors.where(F.col("norm") >= shortest * MARGIN), items, weights, bounds, k)
        out = out.unionByName(best(rows, k).select("item_id", "rank", "doc_id", "score"))
    return out
