"""Small tables with every odd case: nulls, empty and long texts, ties, copies,
and extra columns whose names clash with the operators' own."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows() -> list[tuple]:
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (None, "a text without an id", "en", "src1", 1),
        (None, None, None, None, None),
        (9001, None, "en", "src1", 0),
        (9002, "", "en", "src2", 0),
        (9003, " \t\n ", "en", None, 0),
        (9004, "one", None, "src1", 3),
        (9005, long, "en", "src0", len(long)),
        (9006, "x" * 50_000, "en", "src3", 50_000),
        (9007, "no break and üñí 你好 words 😀 here", "fr", "", 5),
        (9008, "mail a@b.co and 10.0.0.1, card 4111 1111 1111 1111, call +1 (942) 555-3818.", "en", "src0", 5),
        (9009, "<|endoftext|> and <|im_end|> stand in a text", "en", "src0", 5),
    ]
    same = (9010, "the same row stands here three times over and over", "en", "src4", 9)
    return rows + [same] * 3


@pytest.fixture(scope="session")
def edges(spark):
    plain = spark.createDataFrame(edge_rows(), DOCS)
    clash = ["size", "taken", "kept", "host", "rule", "h", "words", "base_spans", "all_spans", "posterior", "fp", "n", "ids"]
    return plain.select("*", *[F.lit(f"own {c}").alias(c) for c in clash])


@pytest.fixture(scope="session")
def docs(spark, edges):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    return given.unionByName(edges.select(*given.columns)).coalesce(4).cache()


@pytest.fixture(scope="session")
def none(edges):
    return edges.where("false")


def random_texts(n: int, letters: str, size: int, seed: int = 5) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(size))) for _ in range(n)]
