"""Integrity checks and reports over the warehouse tables (V1-V7)."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame, functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count for each given table (one UNION ALL)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def multi_current(dim: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Keys with more than one current version: key, current_versions.

    ``strict`` also reports keys with no current version at all (0).
    """
    if not strict:
        return (dim.where(F.col("is_current")).groupBy(key)
                .agg(F.count(F.lit(1)).alias("current_versions"))
                .where(F.col("current_versions") > 1))
    return (dim.groupBy(key)
            .agg(F.count_if(F.col("is_current")).alias("current_versions"))
            .where(F.col("current_versions") != 1))


def current_not_open(dim: DataFrame) -> DataFrame:
    """Current rows that carry a valid_to (must be open)."""
    return dim.where(F.col("is_current") & F.col("valid_to").isNotNull())


def scd2_overlap(dim: DataFrame, key: str) -> DataFrame:
    """Versions whose interval is empty or reversed (valid_to <= valid_from),
    or that overlap the key's next version.  key, valid_from, valid_to, problem."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    nxt = dim.select(key, "valid_from", "valid_to",
                     F.lead("valid_from").over(w).alias("__next_from"))
    problem = (F.when(F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from")),
                      F.lit("reversed"))
               .when(F.col("__next_from").isNotNull()
                     & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("__next_from"))),
                     F.lit("overlap")))
    return (nxt.withColumn("problem", problem).where(F.col("problem").isNotNull())
            .select(key, "valid_from", "valid_to", "problem"))


def orphan_orders(fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Orders without a current customer, and those without a current product:
    order_id, customer_id, missing ('customer' / 'product').

    One pass over the fact: it meets the current versions of both dimensions in two left
    joins (of plain shuffles, so AQE may split a hot key), and every order gives one row
    for each key that was not met, also where a damaged dimension has several
    current versions of the other."""
    cc = dim_customers.where(F.col("is_current")).select("customer_id", F.lit(True).alias("__has_customer"))
    cp = dim_products.where(F.col("is_current")).select("product_id", F.lit(True).alias("__has_product"))
    met = (fact.select("order_id", "customer_id", "product_id")
           .join(cc, "customer_id", "left").join(cp, "product_id", "left"))
    lost = met.where(F.col("__has_customer").isNull() | F.col("__has_product").isNull())
    labels = F.array_compact(F.array(F.when(F.col("__has_customer").isNull(), "customer"),
                                     F.when(F.col("__has_product").isNull(), "product")))
    return lost.select("order_id", "customer_id", F.explode(labels).alias("missing")).distinct()


def dim_as_of(dim: DataFrame, day) -> DataFrame:
    """The versions valid on ``day``: valid_from <= day < valid_to (or open)."""
    d = F.lit(day).cast("date") if isinstance(day, (str, dt.date)) else day
    return dim.where((F.col("valid_from") <= d)
                     & (F.col("valid_to").isNull() | (F.col("valid_to") > d)))


def gold_report(df: DataFrame, by: str = "total_amount", descending: bool = True) -> DataFrame:
    """A gold table in report order."""
    c = F.col(by)
    return df.orderBy(c.desc() if descending else c.asc())


def batch_control_report(control: DataFrame) -> DataFrame:
    """batch_key, times_processed in key order."""
    return (control.groupBy("batch_key").agg(F.count(F.lit(1)).alias("times_processed"))
            .orderBy("batch_key"))


def batch_keys_seen(bronze: DataFrame) -> DataFrame:
    """Distinct batch keys found in a Bronze table's file paths."""
    from keelson.functions import batch_key_of
    return bronze.select(batch_key_of("_source_file").alias("batch_key")).distinct()
