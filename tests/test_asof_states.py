"""As-of merge for long version lists, one-pass orphans, dropped states."""

import datetime as dt
import random

from pyspark.sql import functions as F

from keelson import paths
from keelson.operators import marts, validate
from keelson.plans.warehouse import Warehouse
from tests.helpers import rows, write_customers, write_products

D = dt.date


def day(n):
    return D(2020, 1, 1) + dt.timedelta(days=n)


def versions_of(rnd, key, n, gaps):
    starts = sorted(rnd.sample(range(3000), n))
    out = []
    for a, b in zip(starts, [*starts[1:], None]):
        if gaps and b and rnd.random() < 0.3 and b - a > 1:
            b = rnd.randrange(a + 1, b)
        out.append((key, f"c{a}", day(a), day(b) if b is not None else None))
    return out


def test_as_of_merge_equals_the_range_join(spark):
    rnd = random.Random(3)
    vs = [v for k in range(40) for v in versions_of(rnd, k, rnd.randrange(1, 60), k % 2)] + [(None, "n", day(1), None)]
    fs = [(i, rnd.choice([*range(45), None]), rnd.choice([None, *map(day, range(-50, 3100, 7))])) for i in range(4000)]
    v = spark.createDataFrame(vs, "id int, city string, valid_from date, valid_to date")
    f = spark.createDataFrame(fs, "order_id int, id int, order_date date")
    want = marts.as_of_join(f, v, "id", "order_date").select("order_id", "id", "order_date", "city", "valid_from", "valid_to")
    for days in (1, 64, 100_000):
        got = marts.as_of_merge(f, v, "id", "order_date", days)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert marts.as_of_merge(f.where("false"), v, "id", "order_date").isEmpty()
    assert marts.as_of_merge(f, v.where("false"), "id", "order_date").isEmpty()


def test_a_key_with_many_versions_is_merged_in_pieces(spark):
    n = 10_000
    v = spark.range(n).select(F.lit(1).alias("id"), F.col("id").alias("no"), F.date_add(F.lit(D(1990, 1, 1)), F.col("id").cast("int")).alias("valid_from"))
    v = v.withColumn("valid_to", F.when(F.col("no") < n - 1, F.date_add("valid_from", 1)))
    f = spark.range(200_000).select(F.col("id").alias("order_id"), F.lit(1).alias("id"), F.date_add(F.lit(D(1990, 1, 1)), (F.col("id") % n).cast("int")).alias("order_date"))
    out = marts.as_of_merge(f, v, "id", "order_date").withColumn("task", F.spark_partition_id())
    seen = out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("no") != F.col("order_id") % n).alias("bad"), F.count_distinct("task").alias("tasks")).first()
    assert seen.n == 200_000 and seen.bad == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__p" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_orphans_in_one_pass(spark):
    fact = spark.createDataFrame([(1, 1, "P1"), (2, 2, "P1"), (3, None, "P9"), (4, 1, "P9"), (5, 3, "P1")], "order_id long, customer_id long, product_id string")
    dc = spark.createDataFrame([(1, True), (1, True), (2, False), (3, True)], "customer_id long, is_current boolean")
    dp = spark.createDataFrame([("P1", True), ("P9", False)], "product_id string, is_current boolean")
    got = rows(validate.orphan_orders(fact, dc, dp), "order_id", "missing")
    assert got == [(2, "customer"), (3, "customer"), (3, "product"), (4, "product")]


def test_one_scan_of_the_fact_for_orphans(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.lit("P").alias("product_id"), F.lit("x").alias("note")).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    dc = spark.createDataFrame([(1, True)], "customer_id long, is_current boolean")
    dp = spark.createDataFrame([("P", True)], "product_id string, is_current boolean")
    out = validate.orphan_orders(fact, dc, dp)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "note" not in plan


def test_states_of_old_batches_are_dropped_and_computed(spark, tmp_path):
    land = str(tmp_path / "land")
    for m, (city, cat) in enumerate([("a", "X"), ("a", None), ("b", "X"), ("c", "Y"), ("c", "Y")], 1):
        write_customers(land, f"customers_2026-0{m}.json", [("1", "Ann", city, f"2026-0{m}-02"), (str(m + 1), "Bob", "q", f"2026-0{m}-03")])
        write_products(land, f"products_2026-0{m}.csv", [("P1", "Pen", cat, "1.5", "2025-06-01")])
    whole = Warehouse(spark, str(tmp_path / "whole"), keep_states=None)
    few = Warehouse(spark, str(tmp_path / "few"), keep_states=1)
    for wh in (whole, few):
        wh.ingest(land)
        wh.run_silver(mode="fold")

    def stored(wh):
        return [b for b in wh.committed() if any(paths.exists(spark, p) for p in wh._state_folders(b))]
    assert stored(whole) == whole.committed() and stored(few) == ["2026-05"]
    for bk in ("2026-02", "2026-04"):
        assert rows(few.dim1(bk), "customer_id", "city") == rows(whole.dim1(bk), "customer_id", "city")
        for e in ("customers", "products"):
            cols = whole.dim2(e).columns
            assert sorted(map(repr, few.dim2(e, bk).select(*cols).collect())) == sorted(map(repr, whole.dim2(e, bk).select(*cols).collect()))
    # a stop between the folders of a state: no reader follows what is left
    real, gone = whole._drop_folder, []

    def stop(path):
        if len(gone) == 4:
            raise RuntimeError("stopped")
        gone.append(path)
        real(path)
    before = rows(whole.dim2("products", "2026-02"), "category", "valid_from", "is_current")
    whole._drop_folder = stop
    try:
        whole.drop_old_states(2)
    except RuntimeError:
        pass
    whole._drop_folder = real
    assert rows(whole.dim2("products", "2026-02"), "category", "valid_from", "is_current") == before
    whole.drop_old_states(2)
    assert stored(whole) == ["2026-04", "2026-05"] and whole.drop_old_states(2) == 0
    assert rows(whole.dim2("products", "2026-02"), "category", "valid_from", "is_current") == before
