import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import embeddings
from tests.llm import plain

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(n_links, component id) of every row."""

    def fine(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if fine(v) else None for _, v, _ in rows]

    def linked(i, j):
        a, b = unit[i], unit[j]
        return rows[i][2] is not None and rows[i][2] == rows[j][2] and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.93

    n = len(rows)
    degree = [sum(linked(i, j) for j in range(n) if j != i) for i in range(n)]
    part = plain.components(n, linked)
    least: dict = {}
    for (i, _, _), c in zip(rows, part, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [(d, least.get(c)) for d, c in zip(degree, part, strict=True)]


def vectors(seed, groups, spread, singles, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    for size in groups:
        center = rng.normal(size=dim)
        out += [center + spread * np.linalg.norm(center) / np.sqrt(dim) * rng.normal(size=dim) for _ in range(size)]
    out += [rng.normal(size=dim) for _ in range(singles)]
    return [np.float32(v).tolist() for v in out]


@pytest.mark.parametrize("join", [embeddings.RangeJoin(), embeddings.RangeJoin(cell=20, chunk=8, pivots=16), embeddings.RangeJoin(cell=5, chunk=1000, pivots=40)])
def test_links_and_components(spark, join):
    vs = vectors(1, (40, 25, 3), 0.22, 60)
    rows = [(10 * i + 3, v, i % 3 if i % 2 else 0) for i, v in enumerate(vs)]
    rows += [(5, vs[0], 0), (6, vs[0], 0), (6, vs[0], 0), (7, vs[0], 1), (8, vs[0], None), (None, vs[1], 0)]
    rows += [(901, None, 0), (902, [], 0), (903, [0.0] * 16, 0), (904, [1.0, None] * 8, 0), (905, [float("nan")] * 16, 0), (906, [float("inf")] * 16, 0), (907, vs[2][:8], 0), (908, [2.0 * x for x in vs[2]], 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).select("*", F.lit("own").alias("node"), F.lit("own").alias("n"), F.lit("own").alias("chunk"))
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df, join).collect()), key=str)
    want = sorted(((i, d, c, c is not None and i == c) for (i, _, _), (d, c) in zip(rows, brute(rows), strict=True)), key=str)
    assert got == want


def test_pruning_bound_never_loses_a_pair():
    rng = np.random.default_rng(4)
    m = np.array(vectors(2, (30,) * 20, 0.25, 50), np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    pivots = m[rng.choice(len(m), 12, replace=False)]
    home, near = embeddings.near_cells(m, pivots, 12, np.sqrt(2 - 2 * 0.93), 1e-6)
    hit = np.argwhere(m @ m.T >= 0.93)
    for i, j in hit:
        assert near[i, home[j]] and near[j, home[i]]
    assert near.mean() < 0.9  # clustered vectors are pruned


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).isEmpty()
