import datetime as dt

from pyspark.sql import functions as F

from keelson.functions import batch_key_of, business_date, lenient_date, lenient_date_any, \
    lenient_double, lenient_int


def test_batch_key_from_paths(spark):
    paths = [
        ("file:/x/raw/customers/customers_2026-01.json", "2026-01"),
        ("s3a://b/raw/2026-01/customers_2026-02.json", "2026-02"),  # last token wins
        ("file:/x/customers.json", ""),  # no token
        ("file:/x/customers_2026-13.json", ""),  # not a month
        ("file:/l/customers/src=customers_1995-01.json/part-00000-5678-9012-ab12.c000.json",
         "1995-01"),  # generated part names are not tokens
        ("file:/x/c_20261-01.json", ""),  # glued to more digits
    ]
    df = spark.createDataFrame(paths, "p string, want string")
    got = df.select(batch_key_of("p").alias("bk"), "want").collect()
    assert all(r.bk == r.want for r in got), got


def test_business_date(spark):
    r = spark.range(1).select(business_date(F.lit("2026-03")).alias("d")).first()
    assert r.d == dt.date(2026, 3, 1)


def test_lenient_casts(spark):
    df = spark.createDataFrame([("12", "1.5", "2026-01-05", "2026-01-05 10:00:00"),
                                ("C12", "n/a", "2026-1-5", "not-a-date"),
                                ("12.7", "-1", "2026-01-05 10:00:00", "2026-02-30")],
                               "i string, d string, s string, t string")
    r = df.select(lenient_int("i").alias("i"), lenient_double("d").alias("d"),
                  lenient_date("s").alias("s"), lenient_date_any("t").alias("t")).collect()
    assert r[0] == (12, 1.5, dt.date(2026, 1, 5), dt.date(2026, 1, 5))
    # bad values become NULL instead of failing under ANSI mode
    assert r[1] == (None, None, None, None)
    # a fraction is rejected as an int; a time part fails the strict pattern
    assert r[2].i is None and r[2].d == -1.0 and r[2].s is None and r[2].t is None


def test_byte_setting_reads_spark_size_strings():
    from keelson.operators.sizing import byte_setting
    assert byte_setting("10485760b") == 10485760
    assert byte_setting("64m") == byte_setting("64MB") == 64 << 20
    assert byte_setting("1g") == 1 << 30
    assert byte_setting("2048") == 2048
    assert byte_setting("-1") == -1
    assert byte_setting("lots") == 0 and byte_setting(None) == 0
