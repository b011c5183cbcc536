"""Late rows of committed batches: what came late, and the histories they correct.

A file may arrive for a batch that is already committed.  Batches are never replayed
(that would rewrite the history of every key), so such rows are

* **recorded**: ``late_rows`` names feed, batch, file and rows.  What counts as late is
  exact: at its commit a batch notes which ingests held its rows (``applied``); a
  Bronze partition of a committed batch that is not among them is late.
* **replayed** on demand, for the touched keys alone: their versions are rebuilt from
  the staged rows of all committed batches with the late ones merged, and stored as a
  numbered correction with the batches that opened and closed each version.  Its log
  row commits it.

A correction holds a key's whole history up to ``upto``, the newest batch committed then.
Readers of a state up to that batch take corrected keys from it (as a predicate on
``opened_by`` / ``closed_by``) and all others from the batch folders; the next batch is
folded onto the corrected state, so later folders are right as they are.  Of several
corrections of a key the last one counts.

Layout: ``silver/_late/{applied,rows,log}`` and ``silver/_late/<dimension>/seq=<n>/``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelson import paths
from keelson.operators import scd
from keelson.operators.sizing import join_by_size
from keelson.schemas import SCD2_SPECS
from keelson.sinks.tables import append_path, overwrite_path

LOG = "seq bigint, upto string, at timestamp"
APPLIED = "entity string, batch_key string, ingest_id bigint"
LATE = "entity string, batch_key string, ingest_id bigint, source_file string, n bigint, at timestamp"
TYPE1 = "customers_type1"


def with_keys(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join on a key; the keys are broadcast when their size fits."""
    return join_by_size(df, keys, key, how)


class Corrections:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root}/silver/_late"

    def _read(self, name: str, schema: str) -> DataFrame:
        p = f"{self.path}/{name}"
        if not paths.exists(self.spark, p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(p)

    # ------------------------------------------------------------- record ---
    def note_applied(self, parts: DataFrame, commit: str) -> None:
        """``parts (entity, batch_key, ingest_id)`` of the batches that a commit applies."""
        overwrite_path(parts.coalesce(1), f"{self.path}/applied/{commit}")

    def late_parts(self, parts: DataFrame) -> DataFrame:
        """Of Bronze partitions those of batches that were committed without them and
        that are not recorded yet."""
        applied = self._read("applied", APPLIED)
        known = applied.select("entity", "batch_key").distinct()
        keys = ["entity", "batch_key", "ingest_id"]
        return (parts.join(known, ["entity", "batch_key"], "left_semi")
                .join(applied, keys, "left_anti")
                .join(self.late_rows().select(*keys), keys, "left_anti"))

    def record(self, rows: DataFrame) -> int:
        """Append ``rows (entity, batch_key, ingest_id, source_file, n)``."""
        return append_path(rows.withColumn("at", F.current_timestamp()).coalesce(1), f"{self.path}/rows")

    def late_rows(self) -> DataFrame:
        return self._read("rows", LATE)

    # ------------------------------------------------------------- replay ---
    def log(self) -> DataFrame:
        return self._read("log", LOG)

    def last(self) -> int:
        if not paths.exists(self.spark, f"{self.path}/log"):
            return 0
        return self.log().agg(F.max("seq")).first()[0] or 0

    def replayed(self) -> DataFrame:
        """entity, batch_key, ingest_id of the late partitions that corrections hold."""
        done = self.log().select("seq")
        p = f"{self.path}/replayed"
        if not paths.exists(self.spark, p):
            return self.spark.createDataFrame([], APPLIED)
        return self.spark.read.schema(f"{APPLIED}, seq bigint").parquet(p).join(done, "seq", "left_semi").drop("seq")

    def write(self, seq: int, dim: str, history: DataFrame) -> int:
        return overwrite_path(history, f"{self.path}/{dim}/seq={seq}")

    def commit(self, seq: int, upto: str, parts: DataFrame) -> None:
        overwrite_path(parts.select("entity", "batch_key", "ingest_id").coalesce(1), f"{self.path}/replayed/seq={seq}")
        row = self.spark.createDataFrame([(seq, upto)], "seq bigint, upto string")
        append_path(row.withColumn("at", F.current_timestamp()), f"{self.path}/log")

    def history(self, dim: str, key: str) -> DataFrame | None:
        """Corrected versions of a dimension, each key's last correction, with ``upto``;
        None where there is no correction."""
        p = f"{self.path}/{dim}"
        if not self.last() or not paths.exists(self.spark, p):
            return None
        rows = self.spark.read.parquet(p).withColumn("seq", F.col("seq").cast("bigint"))
        rows = rows.join(F.broadcast(self.log().select("seq", "upto")), "seq")
        newest = rows.groupBy(key).agg(F.max("seq").alias("seq"))
        return rows.join(newest, [key, "seq"], "left_semi").drop("seq")

    # -------------------------------------------------------------- reads ---
    def state(self, dim: str, key: str, base: DataFrame, bk: str, columns: list[str]) -> DataFrame:
        """A state after batch ``bk`` (open versions, or Type 1 rows) with the corrected
        keys' rows in place of those of ``base``."""
        h = self.history(dim, key)
        if h is None:
            return base
        h = h.where(F.col("upto") >= F.lit(bk))
        kept = with_keys(base, h.select(key).distinct(), key, "left_anti")
        now = scd.versions_as_of(h, bk).where("is_current")
        return kept.select(*columns).unionByName(now.select(*columns))

    def closed(self, dim: str, key: str, base: DataFrame, bk: str, columns: list[str]) -> DataFrame:
        """Closed versions up to batch ``bk``; ``base`` also has ``batch_key``, the batch
        that closed them."""
        h = self.history(dim, key)
        if h is None:
            return base.select(*columns)
        upto = h.groupBy(F.col(key).alias("k")).agg(F.max("upto").alias("upto"))
        kept = join_by_size(base, upto, F.col(key) == F.col("k"), "left")
        kept = kept.where(F.col("upto").isNull() | (F.col("batch_key") > F.col("upto")))
        was = scd.versions_as_of(h, bk).where("not is_current")
        return kept.select(*columns).unionByName(was.select(*columns))


    def each(self, dim: str, key: str, base: DataFrame, bks: list[str], columns: list[str]) -> DataFrame:
        """``state`` and ``closed`` after each of ``bks`` at once, with ``as_of``, the batch;
        ``base`` is a history (``opened_by``, ``closed_by``)."""
        h = self.history(dim, key)
        if h is None:
            return scd.versions_after(base, bks).select("as_of", *columns)
        upto = h.groupBy(F.col(key).alias("k")).agg(F.max("upto").alias("upto"))
        # met before the fan-out, so a version is shuffled once and not once a batch
        both = scd.versions_after(join_by_size(base, upto, F.col(key) == F.col("k"), "left"), bks)
        kept = both.where(F.col("upto").isNull() | (F.coalesce("closed_by", "as_of") > F.col("upto")))
        own = scd.versions_after(h, bks).where(~F.col("is_current") | (F.col("upto") >= F.col("as_of")))
        return kept.select("as_of", *columns).unionByName(own.select("as_of", *columns))


def rebuilt(entity: str, staged: DataFrame, effective, null_safe: bool) -> DataFrame:
    """Type 2 history of the keys in ``staged`` (all their rows, one per batch)."""
    spec = SCD2_SPECS[entity]
    return scd.scd2_history(staged, spec["key"], spec["tracked"], effective, null_safe)


def type1_history(staged: DataFrame) -> DataFrame:
    """Type 1 rows of customers by the batches between which each was the latest."""
    from pyspark.sql import Window
    w = Window.partitionBy("customer_id").orderBy("batch_key")
    return staged.select("customer_id", "name", "city", F.col("event_date").alias("update_date"),
                         F.col("event_date").alias("valid_to"), F.lit(True).alias("is_current"),
                         F.col("batch_key").alias("opened_by"), F.lead("batch_key").over(w).alias("closed_by"))
