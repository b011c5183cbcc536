"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits: bit b is 1 if more than half of a text's shingle
hashes have bit b set.  Two fingerprints within Hamming distance ``2 r`` both lie
within ``r`` of some common value, so each distinct fingerprint emits every value
within ``r`` of itself, equal values meet in one shuffle, and fingerprints that
share a value are at most ``2 r`` apart.  Per value only links to the least
fingerprint are kept: all others of that value are linked to it as well, so
components are whole while no group's pairs are spelled out.  Links are
deduplicated and their distance is verified.  An odd distance rounds ``r`` up
and relies on the verification; then stars could lose links, so every pair
of a value is emitted (at most the size of a ball, whatever the data).

Equal texts collapse into one fingerprint before anything is emitted, so
copies cost nothing; a value meets at most a ball of fingerprints (65 for
r = 1), so no key is hot.

Defined results: a null, empty or blank text has the zero fingerprint, which
links like any other; a text shorter than a shingle is one shingle; repeated
rows are copies; a row with a null id gets its component's id but never
names one (null if no row of the component has an id).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import connected_components, shielded, store

SEED = 42
#: Shingles whose bits are unpacked at once.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text as an unsigned 64-bit integer."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white-space characters only
    if not ws:
        return 0
    if len(ws) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(ws), SEED)
    line, ends = b" ".join(ws), np.cumsum([len(w) + 1 for w in ws])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=False)), np.uint64, len(stops))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), CHUNK):
        ones += np.unpackbits(h[k : k + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def content_of(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, content, fp)`` of every row; ``fp`` holds the 64 bits as a signed
    long, ``content`` is a hash of the text itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "content", "fp"])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), content_of(text).alias("content"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, content long, fp long")


def ball(radius: int) -> list[int]:
    """Signed 64-bit masks with at most ``radius`` bits set."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct: DataFrame, max_distance: int = 2) -> DataFrame:
    """``(a, b)`` links between the distinct fingerprints ``fp`` (see above)."""
    radius = (max_distance + 1) // 2
    masks = F.array(*[F.lit(m).cast("long") for m in ball(radius)])
    met = distinct.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
    if max_distance % 2 == 0:
        least = F.min("fp").over(Window.partitionBy("value"))
        pairs = met.select(least.alias("a"), F.col("fp").alias("b"))
    else:
        pairs = met.join(met.select(F.col("fp").alias("b"), F.col("value").alias("v")), (F.col("value") == F.col("v")) & (F.col("fp") < F.col("b"))).select(F.col("fp").alias("a"), "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return pairs.where(F.col("a") < F.col("b")).distinct().where(near)


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id, content, root)`` for every row of ``docs``.

    ``root`` is a component's least fingerprint: rows that share an id but not their
    text may lie in several components, which ``root`` tells apart.
    """
    prints = store(fingerprints(docs, key, text, shingle), "fingerprints")
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(links(distinct, max_distance))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = store(named, "rooted-fingerprints")
    # only linked fingerprints need the least id of their component
    linked = named.join(roots.select(F.col("root").alias("r")).distinct(), F.col("root") == F.col("r"), "left_semi")
    least = linked.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("least"))
    classes = named.join(least, F.col("root") == F.col("r"), "left").select(F.col("fp").alias("f"), F.coalesce("least", "first").alias("component_id"), "root")
    classes = store(classes, "classes")
    return prints.join(classes, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id", "content", "root")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """Of every component the row with its least id, or, where no row of it has one, the
    row of the least text hash.

    A row is known by its id and text, so rows of one id in several components are
    judged each.  Of rows equal in both, one stays: the first of each task and then of
    all, so a heavily repeated row is cut down before the shuffle.
    """
    found = simhash_components(docs, key, text, shingle, max_distance)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "content")).alias("least"))
    # plain equality on three columns: the join's partitioning serves the last step as well
    keys = ["nameless", "number", "content"]
    stays = least.select("least.nameless", F.coalesce("least.doc_id", F.lit(0)).alias("number"), "least.content").distinct()
    inside, back = shielded(docs, [key, text])
    number = F.col(key).cast("long")
    named = inside.withColumns({"nameless": number.isNull(), "number": F.coalesce(number, F.lit(0)), "content": content_of(text)})
    return back(named.join(stays, keys, "left_semi").dropDuplicates(keys))
