"""Feeds are made by many tasks and landed in few files."""

import os

from pyspark.sql import functions as F

from keelson.sources import feeds
from keelson.sources.landing import land


def test_feeds_are_fanned_out_by_many_tasks(spark, sf):
    for feed in (feeds.raw_customers, feeds.raw_products, feeds.odd_products):
        assert feed(spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_landing_writes_files_by_bytes_not_by_tasks(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 16).select(
        F.col("id").cast("string").alias("order_id"),
        F.concat(F.lit("raw/orders/orders_200"), F.col("id") % 5, F.lit("-01.parquet")).alias("_source_file"))
    path = land(rows, str(tmp_path), "orders")
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) == 5
    assert spark.read.parquet(path).count() == 4000
