import random

import pytest
from pyspark.sql import functions as F

from keelson.llm import em, quality
from tests.llm import plain

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(df):
    out = quality.measure(df).select("doc_id", "text", "_q", quality.base_failed(F.col("_q")).alias("base_failed"))
    return out.collect()


def test_counts_equal_plain_ones(docs):
    rows = measured(docs)
    assert len(rows) == docs.count()
    for r in rows:
        want = plain.quality(r.text)
        assert {c: r._q[c] for c in BASE} | {"base_failed": r.base_failed} == want, r.doc_id


def test_counts_of_random_texts(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a", "b", "c ", " ", "\n", "\t", "#", "é ", "😀 "]) for _ in range(rnd.randrange(120))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    for r in measured(df):
        assert {c: r._q[c] for c in BASE} == {c: plain.quality(r.text)[c] for c in BASE}, repr(r.text)


def test_verdicts_agree_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.quality_report(spark.read.parquet(f"{sf}/documents.parquet"))
    seen = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    right, n, clean, kept = seen.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")), F.count("*"), F.expr("count_if(quality = 1)"), F.expr("count_if(quality = 1 and kept)")).first()
    assert n > 250 and right >= 0.97 and kept >= 0.99 * clean
    assert out.where("base_failed and kept").isEmpty()


def test_report_and_rules_agree_and_keep_rows(docs, edges):
    few = docs.where("doc_id < 60 or doc_id > 9000 or doc_id is null")
    a = sorted(map(str, quality.quality_report(few).select("doc_id", "base_failed", "kept").collect()))
    b = sorted(map(str, quality.quality_rules(few).select("doc_id", "base_failed", "kept").collect()))
    assert a == b
    out = quality.quality_rules(edges)
    assert out.count() == edges.count()
    assert set(edges.columns) <= set(out.columns) and out.first()["size"] == "own size" and out.schema["kept"].dataType.typeName() == "boolean"


def test_empty_table(none):
    assert quality.quality_rules(none).isEmpty() and quality.quality_report(none).isEmpty()


def test_em_recovers_reliabilities(spark):
    rnd = random.Random(11)
    right = (0.95, 0.8, 0.9, 0.7)
    rows = []
    for _ in range(4000):
        y = 1 if rnd.random() < 0.7 else -1
        rows.append((y, *[0 if rnd.random() < 0.2 else (y if rnd.random() < p else -y) for p in right]))
    df = spark.createDataFrame(rows, "y int, a int, b int, c int, d int").coalesce(2)
    model = em.fit_votes(df, list("abcd"))
    again = em.fit_votes(df.repartition(3), list("abcd"))
    assert model == again
    odds = model.log_odds([F.col(c) for c in "abcd"])
    hit = df.agg(F.avg(((odds > 0) == (F.col("y") == 1)).cast("int"))).first()[0]
    assert hit > 0.93
    assert model.plus[0] > model.plus[1] and model.plus[2] > model.plus[3] and model.prior == pytest.approx(0.85, abs=0.3)
