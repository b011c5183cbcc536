"""Raw source feeds derived from the driver's tables.

The given tables hold no slowly changing source, so the three raw feeds of
the warehouse (customers as JSON, products as CSV, orders as Parquet) are
derived from them by fixed rules: seven yearly batches 1995-01 .. 2001-01,
keys that arrive late or skip batches, changing names / cities / prices /
categories, uncastable ids, null attributes, bad dates, non-positive prices
and amounts, and duplicate keys inside a batch.  All business columns are
strings, as in a raw drop; ``_source_file`` names the file a row came from.

The batch fan-out is a generator (``explode`` of a short fixed array), not
a join, so each input row is read once and expanded in place.  Rows that are
fanned out are first dealt over as many tasks as a shuffle has: a dimension
is a small file that few tasks read, and they would make all batches' rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keelson.sources.tables import read_table

# Fixed values of the derived feeds (they must stay as they are for results
# to match the oracle): first batch year 1995, seven batches (b = 0..6),
# batch files named <entity>_<1995+b>-01.<ext>.
FIRST_YEAR = 1995
N_BATCHES = 7


def _s(c: Column) -> Column:
    return c.cast("string")


def _dealt(df: DataFrame, key: str) -> DataFrame:
    # a number of its own: AQE would put partitions of few bytes together again
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, key)


def _batch_file(entity: str, ext: str, b: Column) -> Column:
    return F.concat(F.lit(f"raw/{entity}/{entity}_"), _s(F.lit(FIRST_YEAR) + b),
                    F.lit(f"-01.{ext}"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, name, city, event_date, _source_file (all strings)."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    b = F.col("b")
    dup = F.col("dup")
    rows = (_dealt(cust.where(k % 50 != 49), "c_custkey")
            # a key joins at batch (key % 5) and stays: b in [key % 5, 6]
            .withColumn("b", F.explode(F.sequence((k % 5).cast("int"), F.lit(N_BATCHES - 1))))
            .where((k * 7 + b) % 3 != 0)
            # keys % 31 == 0 get a second, earlier row in the same batch
            .withColumn("dup", F.explode(F.when(k % 31 == 0, F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))))
            .withColumn("nk", (F.col("c_nationkey")
                               + F.when(k % 4 == 0, b)
                                  .when((k % 4 == 1) & (b >= 3), F.lit(1)).otherwise(F.lit(0))
                               + F.when(dup == 1, F.lit(7)).otherwise(F.lit(0))) % 25))
    joined = rows.join(nation, rows.nk == nation.n_nationkey, "inner")
    first_day = F.make_date(F.lit(FIRST_YEAR) + b, F.lit(1), F.lit(2))
    return joined.select(
        F.when(k % 97 == 13, F.concat(F.lit("C"), _s(k))).otherwise(_s(k)).alias("customer_id"),
        F.when((k % 89 == 7) & (b == 1), F.lit(None).cast("string"))
         .when((k % 10 == 0) & (b >= 2), F.concat(F.col("c_name"), F.lit(" Jr")))
         .otherwise(F.col("c_name")).alias("name"),
        F.when((k % 83 == 5) & (b == 2), F.lit(None).cast("string"))
         .otherwise(F.col("n_name")).alias("city"),
        F.when((k % 79 == 3) & (b == 3), F.lit("not-a-date"))
         .otherwise(_s(F.date_add(first_day, (k % 27).cast("int") - dup))).alias("event_date"),
        _batch_file("customers", "json", b).alias("_source_file"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, product_name, category, price, launch_date, _source_file."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type",
                                                     "p_retailprice")
    p = F.col("p_partkey")
    b = F.col("b")
    rows = (_dealt(part.where(p % 40 != 39), "p_partkey")
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(N_BATCHES - 1))))
            .where((p + b) % 4 != 0))
    return rows.select(
        F.when((p % 73 == 6) & (b == 1), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P"), _s(p))).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when((p % 11 == 0) & (b >= 4), F.lit("CLEARANCE"))
         .otherwise(F.col("p_type")).alias("category"),
        F.when((p % 61 == 4) & (b == 0), F.lit("-1.0"))
         .when(p % 67 == 2, F.lit("n/a"))
         .when(p % 3 == 0, _s(F.round(F.col("p_retailprice") + 10 * b, 2)))
         .otherwise(_s(F.col("p_retailprice"))).alias("price"),
        F.lit("1994-06-15").alias("launch_date"),
        _batch_file("products", "csv", b).alias("_source_file"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, customer_id, product_id, amount, order_date, _source_file.

    product_id is the smallest part of the order's line items (NULL for an
    order without lines).  The per-order minimum is a partial aggregate, so
    a hot order key is combined on the map side before the shuffle.
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                                         "o_totalprice", "o_orderdate")
    lmin = (read_table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey").agg(F.min("l_partkey").alias("l_min")))
    o = F.col("o_orderkey")
    rows = (orders
            .withColumn("dup", F.explode(F.when(o % 43 == 0, F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))))
            .join(lmin, o == lmin.l_orderkey, "left"))
    day = _s(F.col("o_orderdate").cast("date"))
    return rows.select(
        F.when(o % 101 == 50, F.lit("bad")).otherwise(_s(o)).alias("order_id"),
        _s(F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("P"), _s(F.col("l_min"))).alias("product_id"),
        F.when(o % 53 == 1, F.lit(None).cast("string"))
         .when(o % 59 == 2, F.lit("0"))
         .when(o % 47 == 3, F.lit("-5.0"))
         .otherwise(_s(F.col("o_totalprice"))).alias("amount"),
        day.alias("order_date"),
        F.concat(F.lit("raw/orders/orders_"), F.substring(day, 1, 7),
                 F.lit(".parquet")).alias("_source_file"),
    )


# Odd variants: the same feeds with the cases the plain ones lack, so that every
# cleansing and tie-break rule decides some row.

def odd_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_products with NULL names, categories and launch dates, and duplicates
    per batch: a dearer one (n % 6 = 0) and one of equal price and name (n % 6 = 1),
    where n is the number in product_id."""
    raw = raw_products(spark, sf_dir)
    n = F.substring("product_id", 2, 20).try_cast("bigint")
    copies = F.when(n % 6 < 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = raw.withColumn("dup", F.explode(copies))
    dup = F.col("dup") == 1
    null = F.lit(None).cast("string")
    return rows.select(
        "product_id",
        F.when(n % 13 == 1, null).otherwise(F.col("product_name")).alias("product_name"),
        F.when(dup, F.lit("AAA"))
         .when((n % 7 == 2) & F.col("_source_file").rlike("199[68]-01"), null)
         .otherwise(F.col("category")).alias("category"),
        F.when(dup & (n % 6 == 0), F.concat(F.lit("1"), "price"))
         .when(dup, F.concat(F.lit("0"), "price")).otherwise(F.col("price")).alias("price"),
        F.when(n % 5 == 3, null).otherwise(F.col("launch_date")).alias("launch_date"),
        "_source_file")


def odd_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_orders with dates that carry a time, NULL dates and customers, and
    duplicates that differ by date (n % 5 = 0), amount (1) or product (2), where n is
    the order id."""
    raw = raw_orders(spark, sf_dir)
    n = F.col("order_id").try_cast("bigint")
    rows = raw.withColumn("dup", F.explode(F.when(n % 5 < 3, F.array(F.lit(0), F.lit(1)))
                                           .otherwise(F.array(F.lit(0)))))
    dup = F.col("dup") == 1
    null = F.lit(None).cast("string")
    return rows.select(
        "order_id",
        F.when(n % 9 == 4, null).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(dup & (n % 5 == 2), F.lit("A")).otherwise(F.col("product_id")).alias("product_id"),
        F.when(dup & (n % 5 < 2), F.concat(F.lit("1"), "amount"))
         .otherwise(F.col("amount")).alias("amount"),
        F.when((dup & (n % 5 == 0)) | (n % 11 == 2), null)
         .when(n % 7 == 1, F.concat("order_date", F.lit(" 10:30:00")))
         .otherwise(F.col("order_date")).alias("order_date"),
        "_source_file")


FEEDS = {"customers": raw_customers, "products": raw_products, "orders": raw_orders}


def raw_feed(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return FEEDS[entity](spark, sf_dir)
