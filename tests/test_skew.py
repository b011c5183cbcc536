"""A customer holding a third of all orders: the row-level joins that keep
every order (as-of join, orphan anti join) split that customer's partition
over several tasks (AQE skew join) instead of sending it to one."""

import contextlib

from pyspark.sql import functions as F

from keelson.operators import marts, validate

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


@contextlib.contextmanager
def _conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_fact(spark, n=60000):
    i = F.col("id")
    return spark.range(n).select(
        i.cast("int").alias("order_id"),
        F.when(i % 3 == 0, F.lit(1)).otherwise(i % 500 + 2).cast("int").alias("customer_id"),
        F.concat(F.lit("P"), (i % 50).cast("string")).alias("product_id"),
        F.date_add(F.lit("1996-01-01").cast("date"), (i % 1500).cast("int")).alias("order_date"))


def _versions(spark):
    # two versions per customer, split on 1997-06-01; customer 400 has none
    k = F.col("id").cast("int")
    cut = F.lit("1997-06-01").cast("date")
    old = spark.range(1, 503).where("id <> 400").select(
        k.alias("customer_id"), F.lit("A").alias("city"),
        F.lit("1990-01-01").cast("date").alias("valid_from"), cut.alias("valid_to"),
        F.lit(False).alias("is_current"))
    new = spark.range(1, 503).where("id <> 400").select(
        k.alias("customer_id"), F.lit("B").alias("city"), cut.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    return old.unionByName(new)


def _run(df):
    rows = df.collect()  # runs this frame's own plan, so its final plan is kept
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_as_of_join_splits_a_hot_customer(spark):
    fact, vers = _hot_fact(spark), _versions(spark)
    with _conf(spark, SMALL):
        rows, plan = _run(marts.as_of_join(fact, vers, "customer_id", "order_date")
                          .select("order_id", "customer_id", "city"))
    assert "SortMergeJoin(skew=true)" in plan
    # every order of a known customer meets exactly its one valid version
    want = fact.where("customer_id <> 400").count()
    assert len(rows) == want == len({r.order_id for r in rows})
    got_b = sum(1 for r in rows if r.city == "B")
    assert got_b == fact.where("customer_id <> 400 AND order_date >= DATE'1997-06-01'").count()


def test_orphan_anti_join_splits_a_hot_customer(spark):
    fact, vers = _hot_fact(spark), _versions(spark)
    prods = spark.range(0, 40).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"),
        F.lit(True).alias("is_current"))
    with _conf(spark, SMALL):
        rows, plan = _run(validate.orphan_orders(fact, vers, prods))
    assert "SortMergeJoin(skew=true)" in plan
    by = {}
    for r in rows:
        by[r.missing] = by.get(r.missing, 0) + 1
    assert by["customer"] == fact.where("customer_id = 400").count()
    assert by["product"] == fact.where("CAST(substring(product_id, 2) AS INT) >= 40").count()
