import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, k=10):
    """Every document's score for every item, sorted."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b, n in bags:
            m = 100 - 75 + 75 * n * n_docs // n_terms
            s = 0
            for t in terms(text):
                if t in b:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m))
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_terms_and_pieces(monkeypatch):
    text = "Ab-cd É1;e F_\x00g\n" + "z" * 50 + " é" * 20 + "\x7fÀZ"
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr(ranked, "PIECE", piece)
        got = [t.decode() for part in ranked.folded(text.encode()) for t in part]
        assert got == terms(text)


@pytest.mark.parametrize(("bucket", "pilot", "focus", "per_block"), [(1024, 4096, 6, 1024), (3, 5, 1, 2), (1, 1, 2, 3)])
def test_equals_scoring_everything(spark, monkeypatch, bucket, pilot, focus, per_block):
    for name, v in (("BUCKET", bucket), ("PILOT", pilot), ("FOCUS", focus), ("ITEMS", per_block)):
        monkeypatch.setattr(ranked, name, v)
    rnd = np.random.default_rng(3)
    word = lambda: f"W{int(rnd.zipf(1.3)) % 60}"
    docs = [(i, " ".join(word() for _ in range(int(rnd.integers(0, 80))))) for i in range(150)]
    docs += [(500 + i, "w7 w8 w9 copy") for i in range(40)] + [(None, "w7 w8 w9 copy"), (900, None), (901, " .,;"), (902, "w5"), (902, "w5"), (903, "w1 " * 5000)]
    items = [(i, " ".join(word() for _ in range(12))) for i in range(5)]
    items += [(10, "w7 w8 w9 copy"), (11, None), (12, "nowhere"), (13, "w5 W5 w5"), (13, "w5 W5 w5"), (None, "w9"), (14, "--")]
    df = spark.createDataFrame(docs, DOC).withColumn("key", F.lit("own")).withColumn("norm", F.lit(-1.0)).repartition(5)
    got = rows(ranked.ranked_search(df, spark.createDataFrame(items, ITEM)))
    assert got == sorted(plain(docs, items), key=repr)


def test_given_documents(spark, docs, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert rows(ranked.ranked_search(docs, items)) == sorted(want, key=repr)


def test_buckets_and_coordinates_prune():
    """Of long and short vectors, only few are scored in full."""
    rnd = np.random.default_rng(0)
    weights = np.arange(40, 0, -1).astype(np.int64) * 100
    s = ranked.Search([{0: 1, 1: 1, 5: 2, 30: 1}], weights, [0], 5)
    n = 20_000
    held = [np.unique(rnd.integers(0, 40, 12)) for _ in range(n)]
    impact = [weights[t] * rnd.integers(1, 1000, len(t)) for t in held]
    norm = np.array([math.sqrt(float((x.astype(float) ** 2).sum())) for x in impact])
    order = np.argsort(-norm)
    for k in range(0, n, 500):
        at = order[k : k + 500]
        ends = np.concatenate([[0], np.cumsum([len(held[i]) for i in at])])
        s.bucket(list(map(int, at)), norm[at], ends, np.concatenate([held[i] for i in at]), np.concatenate([impact[i] for i in at]))
    exact = [sum(int(x) * {0: 1, 1: 1, 5: 2, 30: 1}.get(int(t), 0) for t, x in zip(held[i], impact[i], strict=True)) for i in range(n)]
    assert [r[0] for r in s.best[0]] == sorted(exact, reverse=True)[:5]
    assert s.tried < n and s.scored < n / 10


def test_empty_tables(spark, none):
    items = spark.createDataFrame([(1, "a b")], ITEM)
    assert ranked.ranked_search(none, items).isEmpty()
    assert ranked.ranked_search(spark.createDataFrame([(1, "a b")], DOC), items.where("false")).isEmpty()
