"""Silver -> Gold marts.

Every mart first reduces the fact to one row per join key (partial + final
aggregation, combined on the map side) and only then joins the dimension.
A customer or product holding a large share of all orders thus reaches the
join as a single row: no skewed join partition, and the join input shrinks
from |orders| to |keys|.  Sums and counts are decomposable, so the result
equals joining first.  Both sides hold a row per key and are merged: left to
choose, Spark broadcasts a stored dimension for the size of its files, of
which the rows take a multiple in memory.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (dt.date, str)):
        return F.lit(as_of).cast("date")
    return as_of


def current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    return (fact.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count("order_id").alias("__n"),
                              F.sum("amount").alias("__s")))


# grouping_id() of the two sets below, over (customer_id, product_id): a bit
# is set for the column a row is not grouped by
_SET_ID = {"customer_id": 1, "product_id": 2}


def per_key_totals(fact: DataFrame) -> DataFrame:
    """Orders and amount per customer and per product in one pass over the
    fact (grouping sets): customer_id, product_id, __n, __s, __set.  Rows are
    combined per task before the shuffle, so a hot key leaves each task as
    one row.  ``totals_of`` takes one of the two sets out."""
    return (fact.groupingSets([["customer_id"], ["product_id"]], "customer_id", "product_id")
            .agg(F.count("order_id").alias("__n"), F.sum("amount").alias("__s"),
                 F.grouping_id().alias("__set")))


def totals_of(per: DataFrame, key: str) -> DataFrame:
    """key, __n, __s: the totals of one key from ``per_key_totals`` (NULL
    keys dropped, as the inner joins of the marts would)."""
    return (per.where((F.col("__set") == _SET_ID[key]) & F.col(key).isNotNull())
            .select(key, "__n", "__s"))


def sales_by_city(fact: DataFrame, dim_customers: DataFrame, as_of=None,
                  totals: DataFrame | None = None) -> DataFrame:
    """city, total_orders, total_amount, update_date (current city of each
    order's customer; orders of unknown customers drop out).  ``totals``:
    per-customer totals already computed (``totals_of``), else taken from
    ``fact``."""
    cur = current(dim_customers).select("customer_id", "city")
    per = totals if totals is not None else _per_key(fact, "customer_id")
    return (per.join(cur.hint("merge"), "customer_id", "inner")
            .groupBy("city")
            .agg(F.sum("__n").cast("bigint").alias("total_orders"),
                 F.sum("__s").alias("total_amount"))
            .withColumn("update_date", _as_of(as_of)))


def sales_by_category(fact: DataFrame, dim_products: DataFrame, as_of=None,
                      totals: DataFrame | None = None) -> DataFrame:
    """category, total_orders, total_amount, unique_products, update_date."""
    cur = current(dim_products).select("product_id", "category")
    per = totals if totals is not None else _per_key(fact, "product_id")
    return (per.join(cur.hint("merge"), "product_id", "inner")
            .groupBy("category")
            .agg(F.sum("__n").cast("bigint").alias("total_orders"),
                 F.sum("__s").alias("total_amount"),
                 F.count_distinct("product_id").cast("bigint").alias("unique_products"))
            .withColumn("update_date", _as_of(as_of)))


def customer_ranking(fact: DataFrame, dim_customers: DataFrame, k: int = 100,
                     totals: DataFrame | None = None) -> DataFrame:
    """Top ``k`` customers by total amount: customer_id, name, city,
    total_amount, ranking.  Ties are broken by customer_id.

    The top k are taken first (each task keeps its own k, then k of those),
    and only those k rows are numbered: no step moves all customers into one
    task, which a window over the whole table would.
    """
    cur = current(dim_customers).select("customer_id", "name", "city")
    per = totals if totals is not None else _per_key(fact, "customer_id")
    by_customer = (per.join(cur.hint("merge"), "customer_id", "inner")
                   .groupBy("customer_id", "name", "city")
                   .agg(F.sum("__s").alias("total_amount")))
    order = [F.col("total_amount").desc(), F.col("customer_id").asc()]
    top = by_customer.orderBy(*order).limit(k)
    return top.withColumn("ranking", F.row_number().over(Window.orderBy(*order)).cast("int"))


# ------------------------------------------------------- point in time ------

def as_of_join(facts: DataFrame, versions: DataFrame, key: str, date_col: str,
               how: str = "inner") -> DataFrame:
    """Join each fact row to the version of its key valid on its date:
    ``valid_from <= date < valid_to`` (open ``valid_to`` = still valid).

    An equi-join on the key plus a range condition; a key has few versions,
    so each fact row meets only its own key's versions.
    """
    v = versions.withColumnRenamed(key, "__vk")
    cond = ((F.col(key) == F.col("__vk"))
            & (F.col("valid_from") <= F.col(date_col))
            & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col(date_col))))
    return facts.join(v, cond, how).drop("__vk")


def as_of_merge(facts: DataFrame, versions: DataFrame, key: str, date_col: str,
                days: int = 64) -> DataFrame:
    """``as_of_join`` (inner) for keys with many versions: a merge in date order.

    The range join compares every fact row with every version of its key.  Here both
    are put in order and the last version begun is carried along, so a row costs
    the same however many versions its key has.  Time is cut into pieces of ``days``,
    and a piece of a key is one unit of work, so a key with a large share of all rows is
    split; the version that is open when a piece begins is found from one row per
    key and piece.  Versions of a key must not overlap (``validate.scd2_overlap`` tells);
    fact rows without a key or date, or outside every version, drop out.
    """
    piece = lambda d: F.floor(F.unix_date(d) / days).cast("int")
    cols = [c for c in versions.columns if c != key]
    ver = F.struct(*cols)
    v = versions.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()) \
        .select(F.col(key).alias("__k"), piece("valid_from").alias("__p"),
                F.col("valid_from").alias("__d"), ver.alias("__v"))
    f = facts.where(F.col(key).isNotNull() & F.col(date_col).isNotNull()) \
        .select(F.col(key).alias("__k"), piece(date_col).alias("__p"), F.col(date_col).alias("__d"),
                F.struct(*facts.columns).alias("__f"))
    # the last version begun in each piece, carried over the pieces of the key
    begun = v.groupBy("__k", "__p").agg(F.max_by("__v", "__d").alias("__v"))
    seen = f.select("__k", "__p").distinct()
    none_v, none_f = F.lit(None).cast(v.schema["__v"].dataType), F.lit(None).cast(f.schema["__f"].dataType)
    marks = begun.unionByName(seen.withColumn("__v", none_v)) \
        .groupBy("__k", "__p").agg(F.max("__v").alias("__v"))
    before = Window.partitionBy("__k").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    opens = marks.select("__k", "__p", F.last("__v", ignorenulls=True).over(before).alias("__v")) \
        .where(F.col("__v").isNotNull())
    order = {"open": 0, "version": 1, "fact": 2}
    rows = (opens.select("__k", "__p", F.lit(None).cast("date").alias("__d"), F.lit(order["open"]).alias("__o"), "__v", none_f.alias("__f"))
            .unionByName(v.select("__k", "__p", "__d", F.lit(order["version"]).alias("__o"), "__v", none_f.alias("__f")))
            .unionByName(f.select("__k", "__p", "__d", F.lit(order["fact"]).alias("__o"), none_v.alias("__v"), "__f")))
    along = Window.partitionBy("__k", "__p").orderBy(F.col("__d").asc_nulls_first(), "__o") \
        .rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn("__v", F.last("__v", ignorenulls=True).over(along)) \
        .where(F.col("__f").isNotNull() & F.col("__v").isNotNull())
    end = F.col("__v.valid_to")
    return met.where(end.isNull() | (end > F.col("__d"))).select("__f.*", *[F.col(f"__v.{c}") for c in cols])


def _per_key_day(fact: DataFrame, key: str) -> DataFrame:
    # one row per key and order date before the range join: a hot key is
    # reduced to at most one row per day
    return (fact.where(F.col(key).isNotNull() & F.col("order_date").isNotNull())
            .groupBy(key, "order_date").agg(F.count("order_id").alias("__n"),
                                            F.sum("amount").alias("__s")))


def sales_by_city_as_was(fact: DataFrame, dim_customers: DataFrame, as_of=None) -> DataFrame:
    """Sales by the city the customer had on the order date."""
    v = dim_customers.select("customer_id", "city", "valid_from", "valid_to")
    return (as_of_join(_per_key_day(fact, "customer_id"), v, "customer_id", "order_date")
            .groupBy("city")
            .agg(F.sum("__n").cast("bigint").alias("total_orders"),
                 F.sum("__s").alias("total_amount"))
            .withColumn("update_date", _as_of(as_of)))


def sales_by_category_as_was(fact: DataFrame, dim_products: DataFrame, as_of=None) -> DataFrame:
    """Sales by the category the product had on the order date."""
    v = dim_products.select("product_id", "category", "valid_from", "valid_to")
    return (as_of_join(_per_key_day(fact, "product_id"), v, "product_id", "order_date")
            .groupBy("category")
            .agg(F.sum("__n").cast("bigint").alias("total_orders"),
                 F.sum("__s").alias("total_amount"),
                 F.count_distinct("product_id").cast("bigint").alias("unique_products"))
            .withColumn("update_date", _as_of(as_of)))
