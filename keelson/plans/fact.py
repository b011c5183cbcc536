"""The stored order fact: attempts, the partitions they hold, and where an order is.

Layout under ``<root>/silver/silver_fact_orders``:

    attempt=<n>/year=../month=../   rows, written once and never changed
    _parts/<n>/                     its partitions: base, year, month, rows (0: emptied)
    _ids/attempt=<n>/               its order ids, as bitmaps by (year, month, bucket)
    _log/                           started / done rows of attempts

A build writes its own attempt folder and only then its "done" row, which is the commit:
readers take every (year, month) from the newest done attempt that holds it, so a
build that is running, or stopped, cannot be seen, and the next one goes on from the last
done state.  A full build is a new ``base``: partitions of older bases are gone.

**Locator.**  Ids of 32,768 consecutive numbers make a bucket; of each partition and bucket
the ids present are one bitmap of 4 KB (``bitmap_construct_agg``), sorted by bucket.  Where
orders of a new batch are stored is found by a join of their buckets with the bitmaps and a
look at one bit (which months hold any of them: by bitmaps of the batch's own ids): no id
column of the fact is read, and of the bitmaps only the range of
buckets that the batch spans (row groups are skipped by their least and greatest bucket).

**Old folders.**  A partition folder is deleted one build after the build that replaced it,
so a reader that resolved its folders before a build can finish after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelson import paths
from keelson.schemas import TABLES
from keelson.sinks.tables import append_path, overwrite_path

LOG = "phase string, attempt bigint, base bigint, upto_ts timestamp, at timestamp"
PARTS = "attempt bigint, base bigint, year int, month int, n bigint"
IDS = "year int, month int, bucket bigint, bits binary, attempt bigint"

Part = tuple[int | None, int | None]


class FactTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = TABLES["silver_fact_orders"][0]

    # ---------------------------------------------------------------- log ---
    def log(self) -> DataFrame:
        return self._read(f"{self.path}/_log", LOG)

    def _read(self, path: str, schema: str) -> DataFrame:
        if not paths.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def note(self, phase: str, attempt: int, base: int, upto) -> None:
        row = self.spark.createDataFrame([(phase, attempt, base, upto)],
                                         "phase string, attempt bigint, base bigint, upto_ts timestamp")
        append_path(row.withColumn("at", F.current_timestamp()), f"{self.path}/_log")

    def last_done_and_next(self):
        """The newest done row of the log (attempt, base, upto_ts) or None, and the next
        attempt's number, in one look at the log."""
        done = F.col("phase") == "done"
        got = self.log().agg(F.max("attempt").alias("used"),
                             F.max_by(F.when(done, F.struct("attempt", "base", "upto_ts")),
                                      F.when(done, F.col("attempt"))).alias("done")).first()
        return got.done, (got.used or 0) + 1

    def last_done(self):
        return self.last_done_and_next()[0] if paths.exists(self.spark, f"{self.path}/_log") else None

    # -------------------------------------------------------------- parts ---
    def current_parts(self, upto: int | None = None) -> dict[Part, int]:
        """(year, month) -> attempt whose folder holds its rows, as of a done attempt
        (default: the last).  A row per month of the fact reaches the driver."""
        done = self.log().where("phase = 'done'").select("attempt", "base")
        if upto is not None:
            done = done.where(F.col("attempt") <= upto)
        base = done.agg(F.max_by("base", "attempt")).first()[0]
        if base is None:
            return {}
        rows = (self._read(f"{self.path}/_parts", PARTS).join(F.broadcast(done), ["attempt", "base"])
                .where(F.col("base") == base).groupBy("year", "month")
                .agg(F.max("attempt").alias("attempt"), F.max_by("n", "attempt").alias("n")))
        return {(r.year, r.month): r.attempt for r in rows.collect() if r.n}

    def _folder(self, part: Part, attempt: int) -> str:
        return f"{self.path}/attempt={attempt}/year={paths.part(part[0])}/month={paths.part(part[1])}"

    def read(self, months=None, parts: dict[Part, int] | None = None) -> DataFrame:
        """Committed rows, all or of some (year, month) pairs: only their folders are listed.
        ``parts``: the current partitions, when the caller knows them."""
        parts = self.current_parts() if parts is None else parts
        if months is not None:
            parts = {p: a for p, a in parts.items() if p in set(months)}
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.schema(self.schema).option("basePath", self.path) \
                 .parquet(*[self._folder(p, a) for p, a in parts.items()])
        return df.select(*self.schema.fieldNames())

    # ------------------------------------------------------------ locator ---
    @staticmethod
    def _bit(df: DataFrame) -> DataFrame:
        return df.withColumns({"bucket": F.bitmap_bucket_number("order_id"),
                               "bit": F.bitmap_bit_position("order_id")})

    def _bitmaps(self, want: DataFrame, parts: dict[Part, int]) -> DataFrame | None:
        """year, month, bucket, bits of the current partitions over the buckets that
        ``want`` spans; None where either is empty."""
        low, high = want.agg(F.min("bucket"), F.max("bucket")).first()
        if not parts or low is None:
            return None
        current = self.spark.createDataFrame([(a, y, m) for (y, m), a in parts.items()],
                                             "a bigint, y int, m int")
        folders = [f"{self.path}/_ids/attempt={a}" for a in sorted(set(parts.values()))]
        bits = (self.spark.read.schema(IDS).option("basePath", f"{self.path}/_ids").parquet(*folders)
                .where(F.col("bucket").between(low, high)))
        return bits.join(F.broadcast(current), (F.col("attempt") == F.col("a"))
                         & F.col("year").eqNullSafe(F.col("y")) & F.col("month").eqNullSafe(F.col("m")))

    def locate(self, keys: DataFrame, parts: dict[Part, int] | None = None) -> DataFrame:
        """order_id, year, month of those of ``keys (order_id)`` that the fact holds."""
        want = self._bit(keys)
        held = self._bitmaps(want, self.current_parts() if parts is None else parts)
        if held is None:
            return self.spark.createDataFrame([], "order_id bigint, year int, month int")
        byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("bigint")
        found = want.join(held, "bucket").where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
        return found.select("order_id", "year", "month")

    def months_of(self, keys: DataFrame, parts: dict[Part, int] | None = None) -> list[Part]:
        """The (year, month) that hold any of ``keys (order_id)``.

        The keys become bitmaps of their own, so a partition's bucket is compared once
        and not with every key in it: they share an id where both have more bits set
        than their union."""
        want = self._bit(keys)
        held = self._bitmaps(want, self.current_parts() if parts is None else parts)
        if held is None:
            return []
        wanted = want.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("want"))
        each = F.bitmap_count("bits") + F.bitmap_count("want")
        met = (held.join(wanted, "bucket")
               .select("year", "month", "bucket", each.alias("n"), F.explode(F.array("bits", "want")).alias("b"))
               .groupBy("year", "month", "bucket", "n").agg(F.bitmap_or_agg("b").alias("either"))
               .where(F.col("n") > F.bitmap_count("either")))
        return [(r.year, r.month) for r in met.select("year", "month").distinct().collect()]

    # ------------------------------------------------------------- builds ---
    def write(self, rows: DataFrame, attempt: int, base: int, touched: list[Part] | None = None) -> int:
        """Write an attempt's rows, ids and partitions (``touched``: those that it replaces,
        also where no row is left).  Not visible before its "done" row."""
        folder = f"{self.path}/attempt={attempt}"
        n = overwrite_path(rows, folder, ["year", "month"], rebalance=True)
        stored = self.spark.read.schema(self.schema).parquet(folder)
        ids = (self._bit(stored.select("order_id", "year", "month")).groupBy("year", "month", "bucket")
               .agg(F.bitmap_construct_agg("bit").alias("bits")))
        overwrite_path(ids.repartitionByRange("bucket").sortWithinPartitions("bucket"),
                       f"{self.path}/_ids/attempt={attempt}")
        held = stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
        if touched is not None:
            empty = self.spark.createDataFrame([(y, m, 0) for y, m in touched], "year int, month int, n bigint")
            held = held.unionByName(empty).groupBy("year", "month").agg(F.max("n").alias("n"))
        noted = held.select(F.lit(attempt).cast("bigint").alias("attempt"),
                            F.lit(base).cast("bigint").alias("base"), "year", "month", "n")
        overwrite_path(noted.coalesce(1), f"{self.path}/_parts/{attempt}")
        return n

    def replaced_before(self, attempt: int, after: dict[Part, int]) -> list[str]:
        """Folders that the done attempt before ``attempt`` replaced (``after``: the partitions
        as of it): none reads them any more but readers older than two builds."""
        done = sorted(r[0] for r in self.log().where("phase = 'done'").select("attempt").collect())
        earlier = [a for a in done if a < attempt]
        if len(earlier) < 2:
            return []
        before = self.current_parts(earlier[-2])
        return [self._folder(p, a) for p, a in before.items() if after.get(p) != a]
