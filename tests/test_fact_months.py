"""Which months of the fact hold orders of a batch."""

from pyspark.sql import functions as F

from keelson.plans.fact import FactTable


def test_months_of_a_batch(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"))
    assert fact.months_of(spark.range(5).select(F.col("id").alias("order_id")), {}) == []
    month = F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 7)
    orders = spark.range(0, 200_000, 3).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.lit("P1").alias("product_id"),
        F.lit(1.0).alias("amount"), F.lit(None).cast("date").alias("order_date"),
        F.lit(2000).alias("year"), month.cast("int").alias("month"))
    fact.note("started", 1, 1, None)
    fact.write(orders, 1, 1)
    fact.note("done", 1, 1, None)
    for ids in ([3], [1, 2, 100_000], [0, 33, 65_538, 199_998], list(range(30)), [-5, 10**12]):
        keys = spark.createDataFrame([(i,) for i in ids], "order_id bigint")
        held = {(r.year, r.month) for r in fact.locate(keys).select("year", "month").distinct().collect()}
        assert set(fact.months_of(keys)) == held
        assert held == {(2000, i % 7 or None) for i in ids if i % 3 == 0 and 0 <= i < 200_000}
