"""What is broadcast as tables grow."""

from pyspark.sql import functions as F

from keelson.operators import marts, scd
from keelson.operators.sizing import estimated_bytes, fits_broadcast


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, rows):
    """Products whose files are far smaller than their rows."""
    p = str(tmp_path / f"products{rows}")
    spark.range(rows).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"),
                             F.lit("a name that is long and always the same").alias("product_name"),
                             F.lit("STANDARD").alias("category"), F.lit(1.5).alias("price"),
                             F.lit("2000-01-01").cast("date").alias("valid_from"),
                             F.lit(True).alias("is_current")).write.parquet(p)
    return spark.read.parquet(p)


def test_small_files_of_many_rows_are_not_broadcast(spark, tmp_path):
    many, few = stored(spark, tmp_path, 500_000), stored(spark, tmp_path, 100)
    assert estimated_bytes(many) < 10_000_000
    assert not fits_broadcast(many) and fits_broadcast(few)
    step = scd.scd2_step(many, many, "product_id", ["product_name", "category", "price"], F.col("valid_from"))
    assert "BroadcastHashJoin" not in plan_of(step)
    merged = scd.scd1_merge(many.withColumn("update_date", F.col("valid_from")), many.withColumn("d", F.col("valid_from")),
                            "product_id", ["category"], "d")
    assert "BroadcastHashJoin" not in plan_of(merged)
    totals = many.select("product_id", F.lit(2).alias("__n"), F.col("price").alias("__s"))
    mart = marts.sales_by_category(None, many, "2001-01-01", totals=totals)
    assert "BroadcastHashJoin" not in plan_of(mart)
    assert [(r.total_orders, r.unique_products) for r in mart.collect()] == [(1_000_000, 500_000)]
