"""Partitioned writes: file layout with and without rebalancing."""

import os

from pyspark.sql import functions as F

from keelson.sinks.tables import overwrite_path


def _files_per_folder(root):
    out = {}
    for d in sorted(os.listdir(root)):
        if d.startswith("p="):
            out[d] = len([f for f in os.listdir(os.path.join(root, d))
                          if f.endswith(".parquet")])
    return out


def _spread(spark, hot=False):
    # 8 tasks, each holding rows of every partition value
    df = spark.range(0, 40000, numPartitions=8)
    p = F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 4) if hot \
        else F.col("id") % 4
    return df.withColumn("p", p.cast("int")).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))


def test_rebalanced_write_gives_few_files_per_partition(spark, tmp_path):
    plain, balanced = str(tmp_path / "plain"), str(tmp_path / "balanced")
    n1 = overwrite_path(_spread(spark), plain, ["p"])
    n2 = overwrite_path(_spread(spark), balanced, ["p"], rebalance=True)
    assert n1 == n2 == 40000
    assert set(_files_per_folder(plain).values()) == {8}
    assert max(_files_per_folder(balanced).values()) < 8
    a = spark.read.parquet(plain).groupBy("p").count().orderBy("p").collect()
    b = spark.read.parquet(balanced).groupBy("p").count().orderBy("p").collect()
    assert a == b


def test_rebalanced_write_splits_a_hot_partition(spark, tmp_path):
    # value 0 holds most rows; with a small advisory size AQE splits it
    # over several tasks instead of sending all of it to one
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        out = str(tmp_path / "hot")
        assert overwrite_path(_spread(spark, hot=True), out, ["p"], rebalance=True) == 40000
    finally:
        spark.conf.set(key, old)
    files = _files_per_folder(out)
    assert files["p=0"] > 1
    want = _spread(spark, hot=True).where("p = 0").count()
    assert want > 30000
    assert spark.read.parquet(out).where("p = 0").count() == want


def test_rebalanced_write_of_an_empty_frame_counts_zero(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(10).withColumn("p", F.lit(1)).write.parquet(src)
    empty = spark.read.parquet(src).where("p <> 1")
    assert overwrite_path(empty, str(tmp_path / "out"), ["p"], dynamic=True, rebalance=True) == 0
