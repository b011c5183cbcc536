"""The states after many batches, from one history."""

import datetime as dt

from pyspark.sql import functions as F

from keelson.operators import scd


def test_versions_after_many_batches_equal_those_of_each(spark):
    bks = [f"2026-{b:02d}" for b in range(1, 6)]
    data = [(k, bk, [None, "x", "y"][(k * b * b) % 3], dt.date(2026, b, 1))
            for k in range(12) for b, bk in enumerate(bks, 1) if (k + b) % 4]
    history = scd.scd2_history(spark.createDataFrame(data, "k int, batch_key string, a string, d date").coalesce(1),
                               "k", ["a"], F.col("d")).localCheckpoint()
    each = scd.versions_after(history, bks).collect()
    for bk in bks:
        want = sorted(map(repr, map(tuple, scd.versions_as_of(history, bk).collect())))
        assert sorted(repr(tuple(r)[:-1]) for r in each if r.as_of == bk) == want and want
