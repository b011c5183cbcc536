"""Bronze ingestion: pick up new raw files exactly once.

Two steps, each with a bounded state on the driver:

* **find**: the landed files' names are listed and met with the *file ledger* (a Parquet
  table of every name found so far) by an anti join; new names are appended to it, in
  files of at most ``max_files_per_trigger`` rows.  Age plays no part, so a copy that
  keeps an old timestamp is found as well, and no stream has to remember names.
* **read**: a Structured Streaming query (``Trigger.AvailableNow``) follows the ledger, one
  ledger file a micro-batch.  ``foreachBatch`` reads the files that it names and writes them
  to the folder ``ingest_id=<micro-batch>`` of the Bronze table, then notes the partitions
  written in the table's own list (``_parts``).  A run that stops in between is
  repeated by the stream under the same id and replaces that folder; readers take only
  noted ids, so neither a lost executor nor a stop can append twice.

Parquet files may differ in types: the files of a micro-batch are parted until each group
has one schema, every group is scanned with its own types and cast to strings, and the
groups are united.  JSON binds by name; a CSV file must have the header of its micro-batch.
A file that cannot be read (or lacks a column) stops its feed with an error at its micro-batch,
and the next run repeats that.

Rows keep their business columns as strings and get ``_ingestion_ts``, ``_ingestion_date``,
``_source_file`` and the derived ``batch_key``.  ``_parts`` says which folder holds which
batch and day, so a Silver batch lists and reads only its own folders (``read_bronze``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from keelson import paths
from keelson.functions import batch_key_of
from keelson.schemas import RAW_COLUMNS, raw_schema
from keelson.sinks.tables import append_path, overwrite_path

LEDGER = "path string, modified timestamp, length bigint"
PARTS = "ingest_id bigint, _ingestion_date date, batch_key string, n bigint, upto timestamp"
# the ledger has a file per slice of a run; the stream must not forget an unread one
LEDGER_AGE = "36500d"


def landed_files(spark: SparkSession, source_path: str) -> DataFrame:
    """path, modified, length of the non-empty files under a folder (names only)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source_path)
    return (files.where(F.col("length") > 0)
            .select("path", F.col("modificationTime").alias("modified"), "length"))


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not paths.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def find_files(spark: SparkSession, source_path: str, ledger: str, per_file: int) -> int:
    """Append the names not yet in the ledger to it; returns how many."""
    new = landed_files(spark, source_path).join(
        _table(spark, ledger, LEDGER).select("path"), "path", "left_anti")
    if new.isEmpty():
        return 0
    # one writer, so that every ledger file (micro-batch) but the last is full
    return append_path(new.select("path", "modified", "length").repartition(1), ledger,
                       options={"maxRecordsPerFile": per_file})


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Parquet files grouped by types: (schema, files) where one scan reads each group.

    Spark merges the footers of a group in parallel; where their types cannot be
    merged the group (in name order, as types tend to change with time) is halved.
    Groups that come out with the same schema are put together again.
    """
    try:
        schema = spark.read.option("mergeSchema", True).parquet(*files).schema
        return [(schema, list(files))]
    except Exception as e:  # raised in a task, so it comes as the gateway's own error
        if len(files) == 1 or "CANNOT_MERGE_SCHEMA" not in str(e):
            raise
    middle = len(files) // 2
    out: list[tuple[T.StructType, list[str]]] = []
    for schema, names in (*schema_groups(spark, files[:middle]), *schema_groups(spark, files[middle:])):
        same = next((g for g in out if g[0] == schema), None)
        if same:
            same[1].extend(names)
        else:
            out.append((schema, names))
    return out


def scans(spark: SparkSession, entity: str, fmt: str, files: Sequence[str]) -> list[DataFrame]:
    """Scans that together read ``files``, each with the columns of the feed."""
    if fmt == "json":
        groups = [(raw_schema(entity), spark.read.schema(raw_schema(entity)).json(list(files)))]
    elif fmt == "csv":
        r = spark.read.option("header", True).option("sep", ",")
        schema = r.csv(files[0]).schema
        # header names must equal the schema's: a reordered file fails
        # instead of binding columns by position
        groups = [(schema, r.schema(schema).option("enforceSchema", False).csv(list(files)))]
    else:
        groups = [(s, spark.read.schema(s).parquet(*names))
                  for s, names in schema_groups(spark, sorted(files))]
    for schema, _ in groups:
        missing = [c for c in RAW_COLUMNS[entity] if c not in schema.fieldNames()]
        if missing:
            raise ValueError(f"{entity} files lack columns {missing}")
    return [df for _, df in groups]


def bronze_rows(entity: str, scan: DataFrame, ingest_ts: dt.datetime | None) -> DataFrame:
    """Raw strings of a scan with the ingestion columns."""
    ts = F.lit(ingest_ts).cast("timestamp") if ingest_ts else F.current_timestamp()
    out = scan.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[entity]],
                      ts.alias("_ingestion_ts"),
                      F.to_date(ts).alias("_ingestion_date"),
                      F.col("_metadata.file_path").alias("_source_file"))
    return out.withColumn("batch_key", batch_key_of("_source_file"))


def ingest_bronze(spark: SparkSession, entity: str, source_path: str, bronze_path: str,
                  checkpoint: str, fmt: str, ingest_ts: dt.datetime | None = None,
                  max_files_per_trigger: int = 10000) -> int:
    """Append new files of ``source_path`` to the Bronze table at ``bronze_path``.
    Returns the number of rows appended by this run.

    A backlog is split into micro-batches of at most ``max_files_per_trigger``
    files, each committed on its own, so a lost executor or a stopped run
    repeats one micro-batch, not the whole backlog."""
    ledger = f"{checkpoint}/files"
    if paths.has_data_file(spark, source_path):
        find_files(spark, source_path, ledger, max_files_per_trigger)
    if not paths.exists(spark, ledger):
        return 0
    written = []

    def write(slice_: DataFrame, ingest_id: int) -> None:
        here = slice_.sparkSession
        files = [r.path for r in slice_.select("path").collect()]  # at most a ledger file's rows
        if not files:
            return
        rows = reduce(DataFrame.unionByName,
                      [bronze_rows(entity, s, ingest_ts) for s in scans(here, entity, fmt, files)])
        folder = f"{bronze_path}/ingest_id={ingest_id}"
        written.append(overwrite_path(rows, folder, ["_ingestion_date", "batch_key"]))
        note_parts(here, bronze_path, ingest_id)

    names = spark.readStream.schema(LEDGER).option("maxFilesPerTrigger", 1) \
                 .option("maxFileAge", LEDGER_AGE).parquet(ledger)
    q = (names.writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{checkpoint}/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sum(written)


# ------------------------------------------------------------- the table ---

def _written(spark: SparkSession, bronze_path: str, ingest_id: int) -> DataFrame:
    folder = f"{bronze_path}/ingest_id={ingest_id}"
    stamped = "_ingestion_ts timestamp, _ingestion_date date, batch_key string"
    return (spark.read.schema(stamped).parquet(folder).groupBy("_ingestion_date", "batch_key")
            .agg(F.count(F.lit(1)).alias("n"), F.max("_ingestion_ts").alias("upto")))


def note_parts(spark: SparkSession, bronze_path: str, ingest_id: int) -> None:
    """Make a written ingest visible: one row per partition of it in ``_parts``."""
    new = _written(spark, bronze_path, ingest_id).select(F.lit(ingest_id).cast("bigint").alias("ingest_id"),
                                                         "_ingestion_date", "batch_key", "n", "upto")
    overwrite_path(new.coalesce(1), f"{bronze_path}/_parts/{ingest_id}")


def bronze_parts(spark: SparkSession, bronze_path: str) -> DataFrame:
    """ingest_id, _ingestion_date, batch_key, n, upto of every visible partition."""
    p = f"{bronze_path}/_parts"
    if not paths.exists(spark, p):
        return spark.createDataFrame([], PARTS)
    return spark.read.schema(PARTS).option("recursiveFileLookup", "true").parquet(p)


def read_bronze(spark: SparkSession, bronze_path: str, schema: T.StructType,
                batch_keys: Sequence[str] | None = None, since: dt.datetime | None = None) -> DataFrame:
    """Visible rows of a Bronze table: all, those of some batches, or those stamped
    after ``since``.  Only the folders that ``_parts`` names are listed."""
    parts = bronze_parts(spark, bronze_path)
    if batch_keys is not None:
        parts = parts.where(F.col("batch_key").isin(list(batch_keys)))
    if since is not None:
        parts = parts.where(F.col("upto") > F.lit(since))
    ids = "ingest_id", "_ingestion_date", "batch_key"
    if batch_keys is None and since is None:
        # the whole table: its ids are consecutive but for ones without rows
        last = parts.agg(F.max("ingest_id")).first()[0]
        if last is None:
            return spark.createDataFrame([], schema)
        seen = F.col("ingest_id").cast("bigint") <= last
        return spark.read.schema(schema).parquet(bronze_path).where(seen).select(*schema.fieldNames())
    folders = [f"{bronze_path}/ingest_id={i}/_ingestion_date={d}/batch_key={paths.part(b)}"
               for i, d, b in parts.select(*ids).collect()]  # a row per partition that is read
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", bronze_path).parquet(*folders)
    if since is not None:
        rows = rows.where((F.col("_ingestion_date") >= F.to_date(F.lit(since)))
                          & (F.col("_ingestion_ts") > F.lit(since)))
    return rows.select(*schema.fieldNames())


def unread_files(spark: SparkSession, source_path: str, bronze: DataFrame) -> DataFrame:
    """``path`` of non-empty files under ``source_path`` of which Bronze holds no
    row.  Only names and lengths of the landed files are read."""
    def bare(c):  # scheme and the slashes after it are written in several ways
        return F.regexp_replace(c, r"^[a-z0-9]+:/*", "/")
    landed = landed_files(spark, source_path).select(bare("path").alias("path"))
    seen = bronze.select(bare("_source_file").alias("path")).distinct()
    return landed.join(seen, "path", "left_anti")
