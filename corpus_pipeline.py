"""Corpus pipeline: quality, near-duplicates, personal data, mixing, packing.

``run(spark, sf_dir)`` applies the stages to ``documents``.  Every stage but the
last returns the columns of its input; each is written as Parquet under the shared
folder and read back as the next one's input, and its intermediates are removed then.  SQL cannot express the fitted stages
(``ORACLE_SQL`` is None); tests hold each against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import mixing, packing, pii, quality, simhash
from keelson.llm.common import stored_result, table
from keelson.llm.queries import bpe_ranks

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_rows(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash component one row: that with its least id, one of equal rows, or
    one without an id where no row of the component has one."""
    return simhash.first_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span replaced by its kind; ``n_chars`` follows."""
    return pii.mask_texts(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences."""
    return packing.pack(docs, bpe_ranks())


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored_result(lambda: stage(spark, docs, sf_dir), f"pipeline-{name}")  # noqa: B023  called at once
    return docs


QUERIES = {"pipeline": run}
