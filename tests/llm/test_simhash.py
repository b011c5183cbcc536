import random

import pytest
from pyspark.sql import functions as F

from keelson.llm import common, simhash
from tests.llm import plain


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_equal_plain_ones(docs):
    rows = docs.where("length(text) < 20000 or text is null").select("doc_id", "text").collect()
    for r in rows:
        assert simhash.fingerprint(r.text) == plain.fingerprint(r.text), r.doc_id
    got = {(r.doc_id, r.fp) for r in simhash.fingerprints(docs).where("doc_id is not null").collect()}
    assert {(r.doc_id, signed(plain.fingerprint(r.text))) for r in rows if r.doc_id is not None} <= got


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_join_the_components_of_brute_force(spark, distance):
    rnd = random.Random(distance)
    fps = {rnd.getrandbits(64) for _ in range(120)}
    for f in list(fps)[:60]:
        for _ in range(4):
            fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 5))))
    fps |= {0, (1 << 64) - 1, 1, 1 << 63}
    fps = sorted(fps, key=signed)
    want = plain.components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= distance)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long").coalesce(2)
    found = simhash.links(df, distance)
    for a, b in found.collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance
    roots = {r.node: r.root for r in common.connected_components(found).collect()}
    got = [roots.get(signed(f), signed(f)) for f in fps]
    assert got == [signed(fps[c]) for c in want]


def test_component_ids(docs):
    rows = simhash.simhash_components(docs).collect()
    assert len(rows) == docs.count()
    mask = (1 << 64) - 1
    fps = [r.fp & mask for r in rows]
    want = plain.components(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    least: dict = {}
    for r, c in zip(rows, want, strict=True):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert [r.component_id for r in rows] == [least.get(c) for c in want]


def test_long_chains_and_stars_settle(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1000, 1400).select(F.lit(999).cast("long").alias("a"), F.col("id").alias("b"))
    roots = {r.node: r.root for r in common.connected_components(chain.union(star)).collect()}
    assert roots == {i: 0 for i in range(301)} | {999: 999} | {i: 999 for i in range(1000, 1400)}


def test_empty_table(none):
    assert simhash.simhash_components(none).isEmpty()


def test_hex(spark):
    df = spark.createDataFrame([(0,), (255,), (-1,)], "fp long")
    assert [r[0] for r in df.select(simhash.hex_digits(F.col("fp"))).collect()] == ["0" * 16, "00000000000000ff", "f" * 16]
