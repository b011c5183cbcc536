"""Whole-layer flows as single DataFrame plans (no table writes).

Each function derives its input from the given tables and returns a lazy
DataFrame, so Catalyst optimises feed, cleansing, dimension and mart as one
plan.  These are the bulk forms; the stored, batch-by-batch pipeline is in
``keelson.plans.warehouse``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelson.functions import batch_key_of, business_date
from keelson.operators import cleanse, marts, scd
from keelson.schemas import SCD2_SPECS
from keelson.sources import feeds

# Fixed report date of the registered queries (stands for current_date()).
AS_OF = dt.date(2001, 8, 2)


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """A raw feed as Bronze rows: raw strings + _source_file + batch_key."""
    raw = feeds.raw_feed(spark, sf_dir, entity)
    return raw.withColumn("batch_key", batch_key_of("_source_file"))


def stg_customers(spark, sf_dir) -> DataFrame:
    return cleanse.clean_customers(bronze(spark, sf_dir, "customers"))


def stg_products(spark, sf_dir) -> DataFrame:
    return cleanse.clean_products(bronze(spark, sf_dir, "products"))


def fact_orders(spark, sf_dir) -> DataFrame:
    return cleanse.clean_orders(bronze(spark, sf_dir, "orders"))


def scd2_customers(spark, sf_dir, null_safe: bool = False, keep_order_col=False) -> DataFrame:
    s = SCD2_SPECS["customers"]
    return scd.scd2_bulk(stg_customers(spark, sf_dir), s["key"], s["tracked"],
                         F.col("event_date"), null_safe=null_safe,
                         keep_order_col=keep_order_col)


def scd2_products(spark, sf_dir, null_safe: bool = False, keep_order_col=False) -> DataFrame:
    s = SCD2_SPECS["products"]
    return scd.scd2_bulk(stg_products(spark, sf_dir), s["key"], s["tracked"],
                         business_date("batch_key"), null_safe=null_safe,
                         keep_order_col=keep_order_col)


def scd1_customers(spark, sf_dir) -> DataFrame:
    return scd.scd1_bulk(stg_customers(spark, sf_dir), "customer_id", ["name", "city"],
                         "event_date")


def sales_by_city(spark, sf_dir, as_of=AS_OF) -> DataFrame:
    return marts.sales_by_city(fact_orders(spark, sf_dir), scd2_customers(spark, sf_dir), as_of)


def sales_by_category(spark, sf_dir, as_of=AS_OF) -> DataFrame:
    return marts.sales_by_category(fact_orders(spark, sf_dir), scd2_products(spark, sf_dir),
                                   as_of)


def customer_ranking(spark, sf_dir, k: int = 100) -> DataFrame:
    return marts.customer_ranking(fact_orders(spark, sf_dir), scd2_customers(spark, sf_dir), k)
