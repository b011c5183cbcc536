"""Parquet table writes.

* ``overwrite_path``: replace one folder (a whole table, or one batch's
  partition) - the unit a batch rewrites when it is rerun.
* ``write_observed``: any write, returning the rows written from an
  ``Observation`` taken during the write itself (no second pass).
* ``ensure_table`` / ``insert_overwrite`` / ``append``: catalog tables with a
  declared schema, created once (``IF NOT EXISTS``) and written by
  ``insertInto``, which casts to the declared types and fails on overflow.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T


def write_observed(df: DataFrame, do_write: Callable[[DataFrame], None]) -> int:
    obs = Observation()
    do_write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get.get("rows", 0))


def overwrite_path(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                   dynamic: bool = False, rebalance: bool = False) -> int:
    """Write ``df`` as Parquet at ``path``; returns rows written.

    ``dynamic``: replace only the partitions present in ``df``.  Otherwise
    the folder is replaced as a whole (an empty frame leaves it empty).

    ``rebalance``: cluster rows by the partition columns before writing (the
    ``REBALANCE`` hint).  Without it every task writes one file into every
    partition it holds rows of: thousands of tasks times hundreds of months
    of small files.  With it AQE sends each partition's rows to few tasks,
    splits a partition that holds a large share of all rows into pieces of
    the advisory size and merges small ones, so files stay near that size.
    It costs one shuffle, so it is for writes into many partitions.
    """
    if rebalance and partition_by:
        # the count is observed above the shuffle: observed below it, AQE
        # drops the metrics of an input found empty at run time
        df = df.hint("rebalance", *partition_by)

    def go(d: DataFrame) -> None:
        w = d.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        w.parquet(path)
    return write_observed(df, go)


def append_path(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                options: dict | None = None) -> int:
    def go(d: DataFrame) -> None:
        w = d.write.mode("append").options(**(options or {}))
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return write_observed(df, go)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: Sequence[str] = (), location: str | None = None,
                 bucket_by: tuple[str, int] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet (and its database).

    ``bucket_by=(column, n)`` declares the files as n buckets of ``column``,
    sorted by it, so joins and aggregates on it need no shuffle of this side."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    # partition columns go last in a parquet table's schema
    cols = [f for f in schema.fields if f.name not in partition_by] + \
           [schema[c] for c in partition_by]
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(T.StructType(cols))}) USING parquet"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(partition_by)})"
    if bucket_by:
        col, n = bucket_by
        sql += f" CLUSTERED BY ({col}) SORTED BY ({col}) INTO {int(n)} BUCKETS"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def _aligned(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    # insertInto binds by position: order the frame by the table's columns
    return df.select(*spark.table(name).columns)


def insert_overwrite(df: DataFrame, name: str) -> int:
    spark = df.sparkSession
    return write_observed(_aligned(df, spark, name),
                          lambda d: d.write.mode("overwrite").insertInto(name))


def append(df: DataFrame, name: str) -> int:
    spark = df.sparkSession
    return write_observed(_aligned(df, spark, name), lambda d: d.write.insertInto(name))
