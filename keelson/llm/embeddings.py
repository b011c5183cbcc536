"""Near-duplicate vectors by an exact metric range join.

Cosine similarity of at least ``c`` is a Euclidean distance of at most
``r = sqrt(2 - 2 c)`` between unit vectors, so the triangle inequality applies.
Pivots (a bounded sample of the vectors) split each label's vectors into cells by the
nearest pivot.  A pair within ``r`` lies in two cells i and j only if both
vectors are within ``r`` of the plane that separates the two pivots; a vector is
replicated to just the cells whose border it may cross.  Large cells are cut into chunks by a hash, and
every pair of chunks that may hold a pair is joined on its own: a product of two
bounded matrices in double precision.

A chunk pair returns each vector's number of links and a spanning forest of the links
it found (the forest has the same components), never the pairs themselves.
Equal vectors of a label collapse into one row with a multiplicity first.

Cost: the pivots prune as far as the data are clustered at the scale of ``r``.  Where
they are not (unit vectors spread over all directions), every exact method of this kind
compares all chunks of a label, and work is quadratic in a label's distinct vectors.

Defined results: vectors that are null, empty, zero or hold nulls or non-finite
numbers, and rows with a null label, have no links and stand alone; vectors of different
lengths don't link; repeated rows are rows of equal vectors and link to each other; a
row with a null id counts as a link of others but names no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import connected_components, store


@dataclass(frozen=True)
class RangeJoin:
    cosine: float = 0.93
    #: vectors to a cell and to a chunk
    cell: int = 1024
    chunk: int = 2048
    #: most pivots, a bounded sample; shared by all labels
    pivots: int = 64
    #: slack for rounding in the pruning bounds (links are decided on the cosine itself)
    slack: float = 1e-6


def usable(vec: str) -> Column:
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vec, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of equal length as rows, scaled to length one."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    m = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def near_cells(m: np.ndarray, pivots: np.ndarray, used: int, r: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of every row, and a mask of the cells whose border it may cross."""
    p = pivots[:used]
    gap = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))
    d2 = np.maximum(2 - 2 * m @ p.T, 0)
    home = d2.argmin(axis=1)
    own = d2[np.arange(len(m)), home]
    # distance to the plane between the home pivot and each other pivot
    to_plane = (d2 - own[:, None]) / np.maximum(2 * gap[home], 1e-12)
    near = to_plane <= r + slack
    near[gap[home] < 1e-9] = True
    near[np.arange(len(m)), home] = True
    return home, near


def forest(hit: np.ndarray, rows: np.ndarray, columns: np.ndarray, tree: np.ndarray) -> list[tuple[int, int]]:
    """Links of ``hit`` that join two trees; ``tree`` (of every vector) is updated."""
    kept = []
    for k in np.flatnonzero(hit.any(axis=1)):
        x, linked = rows[k], columns[hit[k]]
        trees = tree[linked]
        if (trees == tree[x]).all():
            continue
        for t, at in zip(*np.unique(trees, return_index=True), strict=True):
            if t != tree[x]:
                kept.append((int(x), int(linked[at])))
                tree[tree == t] = tree[x]
    return kept


def compare(cosine: float, rows: int = 512):
    """A group function: links between the two sides of one chunk pair."""

    def run(group: pa.Table) -> pa.Table:
        schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])
        left, right = group["left"][0].as_py(), group["right"][0].as_py()
        nodes, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        side = np.array([x == left for x in group["chunk"].to_pylist()])
        m = _matrix(group["embedding"])
        first, second = np.flatnonzero(side), (np.flatnonzero(side) if left == right else np.flatnonzero(~side))
        count = np.zeros(len(m), np.int64)
        tree, edges = np.arange(len(m)), []
        for k in range(0, len(first), rows):
            part = first[k : k + rows]
            hit = m[part] @ m[second].T >= cosine
            if left == right:
                hit[np.arange(len(part)), np.arange(k, k + len(part))] = False
            else:
                count[second] += copies[part] @ hit
            count[part] += hit @ copies[second]
            edges += forest(hit, part, second, tree)
        some = np.flatnonzero(count)
        a = np.array([x for x, _ in edges], np.int64)
        b = np.array([y for _, y in edges], np.int64)
        zero = np.zeros(len(edges), np.int64)
        return pa.Table.from_arrays(
            [pa.array(np.concatenate([nodes[some], nodes[a]])), pa.array(np.concatenate([nodes[some], nodes[b]])), pa.array(np.concatenate([count[some], zero]))], schema=schema
        )

    return run


def near_duplicates(vectors: DataFrame, join: RangeJoin | None = None, key: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    join = join or RangeJoin()
    r = float(np.sqrt(2 - 2 * join.cosine))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("embedding"), F.col(label).alias("label"))
    rows = rows.withColumn("ok", F.coalesce(F.col("label").isNotNull() & usable("embedding"), F.lit(False)))
    classes = rows.where("ok").groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = store(classes.withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("embedding"), "h": F.xxhash64("embedding")}), "vector-classes")

    # pivots: the vectors of the least hashes, a sample whose size is a parameter
    sample = classes.select("embedding", "dim", "h").orderBy("h").limit(join.pivots).collect()
    by_dim: dict[int, list] = {}
    for s in sample:
        by_dim.setdefault(s.dim, []).append(s.embedding)
    pivots = {d: _matrix(pa.array(p, pa.list_(pa.float64()))) for d, p in by_dim.items()}
    sizes = classes.groupBy(F.col("label").alias("l"), F.col("dim").alias("d")).agg(F.count(F.lit(1)).alias("size"))
    cells = F.least(F.greatest(F.ceil(F.col("size") / join.cell), F.lit(1)), F.lit(join.pivots)).cast("int")
    sized = classes.join(sizes.select("l", "d", cells.alias("cells")), (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d")))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, near = np.zeros(b.num_rows, np.int32), [None] * b.num_rows
            dims, used = b.column("dim").to_numpy(), b.column("cells").to_numpy()
            for d, n in set(zip(dims.tolist(), used.tolist(), strict=True)):
                at = np.flatnonzero((dims == d) & (used == n))
                if d not in pivots:  # a length that the sample missed has one cell
                    for i in at:
                        near[i] = [0]
                    continue
                m = _matrix(b.column("embedding").take(pa.array(at)))
                h, mask = near_cells(m, pivots[d], min(n, len(pivots[d])), r, join.slack)
                home[at] = h
                for i, row in zip(at, mask, strict=True):
                    near[i] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("label"), b.column("dim"), b.column("embedding"), b.column("copies"), b.column("h"), pa.array(home, pa.int32()), pa.array(near, pa.list_(pa.int32()))],
                ["node", "label", "dim", "embedding", "copies", "h", "home", "near"],
            )

    kind = vectors.select(F.col(label).alias("label")).schema["label"].dataType.simpleString()
    fields = f"node long, label {kind}, dim int, embedding array<double>, copies long, h long, home int, near array<int>"
    placed = store(sized.select("node", "label", "dim", "embedding", "copies", "h", "cells").mapInArrow(assign, fields), "vector-cells")

    counts = placed.groupBy("label", "dim", "home").agg(F.ceil(F.count(F.lit(1)) / join.chunk).cast("int").alias("chunks"))
    counts = store(counts, "vector-chunks")
    mine = counts.select(F.col("label").alias("l"), F.col("dim").alias("d"), F.col("home").alias("c"), F.col("chunks").alias("own"))
    theirs = counts.select(F.col("label").alias("l2"), F.col("dim").alias("d2"), F.col("home").alias("c2"), "chunks")
    chunked = placed.join(mine, (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d")) & (F.col("home") == F.col("c")))
    chunk = F.col("home").cast("long") * (1 << 32) + F.pmod(F.xxhash64("h"), F.col("own"))
    chunked = chunked.select("node", "label", "dim", "embedding", "copies", chunk.alias("chunk"), F.explode("near").alias("cell"))
    met = chunked.join(theirs, (F.col("label") == F.col("l2")) & (F.col("dim") == F.col("d2")) & (F.col("cell") == F.col("c2")))
    partner = F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.col("cell").cast("long") * (1 << 32) + k))
    met = met.select("node", "label", "dim", "embedding", "copies", "chunk", partner.alias("partner"))
    met = met.withColumns({"left": F.least("chunk", "partner"), "right": F.greatest("chunk", "partner")}).drop("partner")
    found = store(met.groupBy("label", "dim", "left", "right").applyInArrow(compare(join.cosine), "node long, other long, n long"), "vector-links")

    links = found.where("node = other").groupBy(F.col("node").alias("m")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.join(roots.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left")
    named = store(named.join(links, F.col("node") == F.col("m"), "left").select("node", "label", "embedding", "first", F.coalesce("root", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-classes-linked")
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
    known = store(named.join(least, F.col("root") == F.col("r")).select(F.col("label").alias("l"), F.col("embedding").alias("v"), "n_links", "component_id"), "vector-components")
    out = rows.join(known, F.col("ok") & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("v")), "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
