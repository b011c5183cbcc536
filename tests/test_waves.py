"""Feeds that arrive in waves are derived once."""

from pyspark.sql import functions as F

from keelson.functions import batch_key_of
from keelson.plans import flows, stored
from keelson.streaming.ingest import landed_files


def test_a_feed_of_several_waves_is_written_once(spark, tmp_path, monkeypatch):
    made, asked = spark.sparkContext.accumulator(0), []

    def one(i):
        made.add(1)
        return (i,)

    def bronze(_spark, _sf, entity):
        asked.append(entity)
        rows = spark.createDataFrame(spark.sparkContext.range(0, 30, 1, 2).map(one), "id bigint")
        name = F.when(F.col("id") < 27, F.concat(F.lit("raw/orders/orders_199"), (F.col("id") % 9).cast("string"), F.lit("-01.parquet")))
        return rows.select(F.col("id").cast("string").alias("order_id"), name.alias("_source_file")) \
                   .withColumn("batch_key", batch_key_of("_source_file"))

    monkeypatch.setattr(flows, "bronze", bronze)
    root = str(tmp_path)
    come = stored.in_waves(spark, "", root, lambda e: (F.col("batch_key") > F.lit("1994-01")).cast("int"), ["orders"])
    assert not (tmp_path / "landing").exists()

    def landed():
        return sorted(int(r[0]) for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/landing/orders").collect())

    first = [i for i in range(27) if i % 9 <= 4]
    come(0)
    assert landed() == first
    files = {r.path for r in landed_files(spark, f"{root}/landing/orders").collect()}
    come(1)
    assert landed() == list(range(27))  # the rows without a file are in no wave
    assert files < {r.path for r in landed_files(spark, f"{root}/landing/orders").collect()}
    come(2)  # a wave without rows
    assert asked == ["orders"] and made.value == 30


def test_late_waves_part_the_rows(spark, sf):
    for e in ("customers", "products", "orders"):
        bk, late = F.col("batch_key"), stored.is_late(e)
        before = [(bk <= stored.WAVE_SPLIT) & ~late, (bk > stored.WAVE_SPLIT) & (bk <= stored.LATE_AFTER) & ~late,
                  late, (bk > stored.LATE_AFTER) & ~late]
        rows = flows.bronze(spark, sf, e).withColumn("wave", stored.late_wave(e))
        wrong = rows.where(F.coalesce(F.element_at(F.array(*before), F.col("wave") + 1), F.lit(False)) == F.lit(False))
        assert wrong.isEmpty()
