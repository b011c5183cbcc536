"""Bronze -> Silver cleansing and typing (customers, products, orders).

Each function takes Bronze rows (raw string columns plus ``batch_key``) and
returns typed, filtered rows with one row per key and batch.  Values that do
not parse become NULL (lenient casts) and are then filtered, as a raw feed
with bad values must not stop the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from keelson.functions import (batch_key_of, lenient_date, lenient_date_any,
                               lenient_double, lenient_long)
from keelson.operators.dedup import dedup_first


def with_batch_key(df: DataFrame, path_col: str = "_source_file") -> DataFrame:
    """Add ``batch_key`` from the file path unless the rows carry one."""
    if "batch_key" in df.columns:
        return df
    return df.withColumn("batch_key", batch_key_of(path_col))


def clean_customers(bronze: DataFrame) -> DataFrame:
    """batch_key, customer_id BIGINT, name, city, event_date DATE.

    A NULL in any of the four columns drops the row; per batch and key the
    row with the latest event_date is kept (then name, city).
    """
    typed = with_batch_key(bronze).select(
        "batch_key",
        lenient_long("customer_id").alias("customer_id"),
        "name", "city",
        lenient_date("event_date", "yyyy-MM-dd").alias("event_date"))
    kept = typed.where(F.col("customer_id").isNotNull() & F.col("name").isNotNull()
                       & F.col("city").isNotNull() & F.col("event_date").isNotNull())
    return dedup_first(kept, ["batch_key", "customer_id"],
                       [("event_date", True), ("name", False), ("city", False)])


def clean_products(bronze: DataFrame) -> DataFrame:
    """batch_key, product_id, product_name, category, price DOUBLE, launch_date DATE.

    Only product_id and a positive price are required; name, category and
    launch date may be NULL.  Per batch and key the lowest price is kept.
    """
    typed = with_batch_key(bronze).select(
        "batch_key", "product_id", "product_name", "category",
        lenient_double("price").alias("price"),
        lenient_date("launch_date", "yyyy-MM-dd").alias("launch_date"))
    kept = typed.where(F.col("product_id").isNotNull() & (F.col("price") > 0))
    return dedup_first(kept, ["batch_key", "product_id"],
                       [("price", False), ("product_name", False), ("category", False),
                        ("launch_date", False)])


# Which row of an order is kept: latest order_date, then the smallest amount,
# product_id, customer_id.  The incremental fact build merges with it too.
ORDER_RULE = [("order_date", True), ("amount", False), ("product_id", False),
              ("customer_id", False)]


def clean_orders(bronze: DataFrame) -> DataFrame:
    """The order fact: order_id, customer_id, product_id, amount, order_date, year, month.

    Restated from all Bronze orders (not per batch).  customer_id and
    order_date may be NULL (orphans, NULL partition); one row per order_id,
    the latest order_date first.
    """
    typed = bronze.select(
        lenient_long("order_id").alias("order_id"),
        lenient_long("customer_id").alias("customer_id"),
        "product_id",
        lenient_double("amount").alias("amount"),
        lenient_date_any("order_date").alias("order_date"))
    kept = (typed.fillna({"amount": 0.0})
            .where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull()
                   & (F.col("amount") > 0)))
    one = dedup_first(kept, ["order_id"], ORDER_RULE)
    return one.withColumns({"year": F.year("order_date").cast("int"),
                            "month": F.month("order_date").cast("int")})


def _first_reason(*tests) -> Column:
    """The name of the first test that holds; NULL when none does."""
    return F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in tests])


# Why a raw row is rejected, tested in this order (on the raw string columns).
REJECTS = {
    "customers": lambda: _first_reason(
        ("customer_id", lenient_long("customer_id").isNull()),
        ("name", F.col("name").isNull()),
        ("city", F.col("city").isNull()),
        ("event_date", lenient_date("event_date", "yyyy-MM-dd").isNull())),
    "products": lambda: _first_reason(
        ("product_id", F.col("product_id").isNull()),
        ("price", ~F.coalesce(lenient_double("price") > 0, F.lit(False)))),
    "orders": lambda: _first_reason(
        ("order_id", lenient_long("order_id").isNull()),
        ("product_id", F.col("product_id").isNull()),
        ("amount", ~F.coalesce(lenient_double("amount") > 0, F.lit(False)))),
}


def rejected_rows(bronze: DataFrame, entity: str) -> DataFrame:
    """The raw rows of a feed that cleansing drops, with the ``reason``: the
    first column that failed.  Duplicates of a kept key are not rejects."""
    return (with_batch_key(bronze).withColumn("reason", REJECTS[entity]())
            .where(F.col("reason").isNotNull()))
