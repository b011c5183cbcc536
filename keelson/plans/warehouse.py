"""The stored warehouse: Bronze -> Silver -> Gold with batch commits.

Layout under ``root`` (a folder every executor can reach, e.g. under the
session's ``spark.checkpoint.dir`` or a table bucket):

    bronze/bronze_raw_<entity>/ingest_id=../_ingestion_date=../batch_key=../
    bronze/bronze_raw_<entity>/_parts/           (its visible partitions)
    _streams/<entity>/files/, stream/            (file ledger, checkpoint)
    silver/silver_stg_<entity>/batch_key=<bk>/                    (per batch)
    silver/silver_dim_customers_type1/batch_key=<bk>/             (snapshot)
    silver/silver_dim_<entity>_type2/batch_key=<bk>/is_current=true|false/
                                                  (open versions of the newest batches only)
    silver/silver_fact_orders/attempt=../year=../month=../   (see ``plans/fact.py``)
    silver/silver_batch_control/                                  (commit log)
    silver/silver_refused_batches/                (batches that came too late)
    silver/_late/                                 (late rows and corrections)
    silver/_fact_stage/, silver/_bucket_log/      (build stage, bucket counts)
    silver/_run_log/                              (what each step read and wrote)
    gold/gold_<mart>/, gold/_gold_log/

A Type 2 dimension is stored as *closed* versions, appended under the batch
that closed them, plus the *open* versions as of each batch.  A batch
writes only its own ``batch_key=<bk>`` folders and then appends its control
row; that row is the commit.  Readers take the open versions of the newest
committed batch and the closed versions of committed batches, so a batch
that stopped half way is invisible, and its rerun overwrites its own
folders.  History is never rewritten: a batch costs O(open versions + batch).

Pending batches are applied either one by one (``fold``) or all in one pass
(``bulk``: an ordered fold of each key's rows inside one aggregate, equal to the fold also
across NULLs).  ``auto`` takes the bulk pass for more than one batch.  With
``buckets`` the folded versions are stored bucketed by key, so the next
batch's join does not shuffle the dimension.

Ingestion and the Silver run are meant to run one after the other (as
``run`` does): the fact build picks up Bronze rows by ingestion time.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from keelson import paths
from keelson.functions import business_date
from keelson.operators import cleanse, marts, scd
from keelson.operators.dedup import dedup_first
from keelson.operators.sizing import join_by_size
from keelson.plans.corrections import TYPE1, Corrections, rebuilt, type1_history, with_keys
from keelson.plans.fact import FactTable
from keelson.schemas import SCD2_SPECS, TABLES
from keelson.sinks.tables import append_path, overwrite_path, write_observed
from keelson.sources.landing import EXT
from keelson.streaming.ingest import bronze_parts, ingest_bronze, read_bronze

ENTITIES = ("customers", "orders", "products")
DIM2 = {"customers": "silver_dim_customers_type2", "products": "silver_dim_products_type2"}


def concurrently(*jobs):
    """Run independent Spark actions from threads; Spark schedules their jobs
    side by side.  Returns their results in order; the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(j) for j in jobs]
        return [f.result() for f in futures]


_UNKNOWN = object()


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, null_safe: bool = False,
                 batch_source: str = "customers", max_files_per_trigger: int = 10000,
                 buckets: int | None = None, late: str = "record",
                 keep_states: int | None = 2):
        """``keep_states``: open versions and Type 1 rows are kept as stored states of that
        many newest batches (None: of all); the state after an older batch is
        computed from the staged batches (see ``drop_old_states``).

        ``late``: rows that arrive for a committed batch are recorded (``late_rows``) and
        not applied to the dimensions ("record", as the reference does not apply
        them), or a Silver run also rebuilds the touched keys' histories ("replay").

        ``buckets``: store each batch's Type 2 versions bucketed by key into
        that many buckets (at least ``spark.sql.shuffle.partitions``), so the
        next batch's shuffle join moves only the batch, not the dimension."""
        self.spark = spark
        self.buckets = buckets
        self.max_files_per_trigger = max_files_per_trigger
        self.root = root.rstrip("/")
        self.null_safe = null_safe
        self.batch_source = batch_source  # "customers" (as the reference) or "both"
        self.late = late
        self.keep_states = keep_states
        self._late = Corrections(spark, self.root)
        self._fact = FactTable(spark, self.path("silver_fact_orders"))
        self._found_upto = None  # newest ingestion time seen by the last ``pending``
        self._staged: list[tuple] = []  # rows of the run log not yet written

    # ------------------------------------------------------------ paths ---
    def path(self, table: str) -> str:
        return f"{self.root}/{table.split('_', 1)[0]}/{table}"

    def _exists(self, path: str) -> bool:
        return paths.exists(self.spark, path)

    def _schema(self, table: str, with_batch: bool = False):
        from pyspark.sql import types as T
        s = TABLES[table][0]
        if with_batch and "batch_key" not in s.fieldNames():
            s = T.StructType(s.fields + [T.StructField("batch_key", T.StringType())])
        return s

    def _read(self, table: str, with_batch: bool = False) -> DataFrame:
        schema = self._schema(table, with_batch)
        p = self.path(table)
        if not self._exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(p)

    # ----------------------------------------------------------- bronze ---
    def ingest(self, landing_root: str, ingest_ts: dt.datetime | None = None) -> dict:
        """Append new landing files of each feed to Bronze (exactly once).

        ``ingest_ts`` fixes the ingestion time (tests); it must grow from run
        to run, as batch discovery and the fact build take rows stamped after
        their marks."""
        def one(e):
            return lambda: ingest_bronze(self.spark, e, f"{landing_root.rstrip('/')}/{e}",
                                         self.path(f"bronze_raw_{e}"),
                                         f"{self.root}/_streams/{e}", EXT[e], ingest_ts,
                                         self.max_files_per_trigger)
        counts = dict(zip(ENTITIES, concurrently(*[one(e) for e in ENTITIES])))
        self._log_run([("ingested", f"bronze_raw_{e}", n) for e, n in counts.items()])
        return counts

    def run_log(self) -> DataFrame:
        """What each finished step did: item, name, n, at.  Items: ``ingested``
        (rows per Bronze table), ``pending``, ``applied``, ``refused`` (one row
        per batch key), ``late`` (rows per feed and committed batch), ``staged`` (rows per table and batches), ``fact`` and
        ``gold`` (rows written), ``batches`` (a Silver run's batch counts).
        Rows of one step share ``at``; a step that stopped half way logs nothing."""
        p = f"{self.root}/silver/_run_log"
        schema = "item string, name string, n bigint, at timestamp"
        if not self._exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(p)

    def _log_run(self, rows: list[tuple]) -> None:
        df = self.spark.createDataFrame(rows, "item string, name string, n bigint")
        append_path(df.coalesce(1).withColumn("at", F.current_timestamp()),
                    f"{self.root}/silver/_run_log")

    def bronze(self, entity: str, batch_keys=None, since=None) -> DataFrame:
        """Bronze rows of a feed: all, of some batches, or ingested after a time
        (only the folders that hold such rows are listed)."""
        name = f"bronze_raw_{entity}"
        return read_bronze(self.spark, self.path(name), self._schema(name), batch_keys, since)

    # ---------------------------------------------------------- control ---
    def control(self) -> DataFrame:
        return self._read("silver_batch_control")

    def committed(self) -> list[str]:
        return sorted(r[0] for r in self.control().select("batch_key").distinct().collect())

    def last_committed(self) -> str | None:
        return self.control().agg(F.max("batch_key")).first()[0]

    def _batch_rows(self, since=None) -> DataFrame:
        """batch_key, _ingestion_ts of the Bronze rows that name batches
        (customers, or both feeds); ``since``: only rows ingested after it,
        read from the ingestion-date partitions from that day on."""
        sources = ["customers"] if self.batch_source == "customers" else ["customers", "products"]
        return reduce(DataFrame.unionByName,
                      [self.bronze(e, since=since).select("batch_key", "_ingestion_ts")
                       for e in sources])

    def discover(self) -> DataFrame:
        """Distinct batch keys present in Bronze (customers, or both feeds)."""
        return (self._batch_rows().select("batch_key")
                .where(F.col("batch_key").isNotNull() & (F.col("batch_key") != "")).distinct())

    def _discovery_log(self) -> DataFrame:
        p = f"{self.root}/silver/_discovery_log"
        schema = "upto_ts timestamp, at timestamp"
        if not self._exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(p)

    def _discovery_mark(self):
        """Ingestion time up to which every batch found in Bronze is committed
        (None: look at all of Bronze)."""
        return self._discovery_log().agg(F.max("upto_ts")).first()[0]

    def pending(self) -> list[str]:
        """Batch keys found in Bronze and not yet committed, in order.

        Only Bronze rows ingested after the discovery mark are read: batches
        of older rows were all committed when the mark was set (a Silver run
        sets it only after committing everything it found).  One aggregate
        gives each batch key of those rows, whether it is committed, and its
        newest ingestion time; only these few rows reach the driver."""
        done = self.control().select("batch_key").distinct().withColumn("committed", F.lit(True))
        per_key = (self._batch_rows(self._discovery_mark()).groupBy("batch_key")
                   .agg(F.max("_ingestion_ts").alias("upto"))
                   .join(done, "batch_key", "left"))
        rows = per_key.collect()
        self._found_upto = max((r.upto for r in rows if r.upto is not None), default=None)
        keys = sorted(r.batch_key for r in rows if r.batch_key and not r.committed)
        if not keys and self.last_committed() is None:
            raise ValueError("no batch key found in Bronze: file names must carry a "
                             "YYYY-MM token")
        return keys

    def _advance_discovery(self, found: list[str]) -> None:
        """Once every batch ``pending`` found is in the control log, later
        runs need not look at the rows it read.  Checked against the log,
        not assumed: a run that stopped without committing leaves the mark."""
        settled = set(self.committed()) | set(self.refused())
        if self._found_upto is not None and set(found) <= settled:
            row = self.spark.createDataFrame([(self._found_upto,)], "upto_ts timestamp")
            append_path(row.withColumn("at", F.current_timestamp()),
                        f"{self.root}/silver/_discovery_log")

    def refused_batches(self) -> DataFrame:
        """Batches that came after a newer one was committed: batch_key,
        last_committed, at.  Replaying them would rewrite Type 2 history."""
        p = f"{self.root}/silver/silver_refused_batches"
        schema = "batch_key string, last_committed string, at timestamp"
        if not self._exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(p)

    def refused(self) -> list[str]:
        return sorted(r[0] for r in self.refused_batches().select("batch_key").distinct().collect())

    def _refuse(self, bks: list[str], last: str) -> None:
        new = sorted(set(bks) - set(self.refused()))
        if new:
            rows = self.spark.createDataFrame([(b, last) for b in new],
                                              "batch_key string, last_committed string")
            append_path(rows.withColumn("at", F.current_timestamp()),
                        f"{self.root}/silver/silver_refused_batches")

    # ----------------------------------------------------------- silver ---
    def _folder(self, table: str, **parts) -> DataFrame:
        """One partition folder of a table, read directly: only its files are
        listed, and its size (the broadcast check) is that of the folder.
        The partition values come back as literal columns."""
        from pyspark.sql import types as T
        schema = self._schema(table, with_batch="batch_key" in parts)
        data = T.StructType([f for f in schema.fields if f.name not in parts])
        sub = "/".join(f"{k}={str(v).lower() if isinstance(v, bool) else v}"
                       for k, v in parts.items())
        p = f"{self.path(table)}/{sub}"
        df = (self.spark.read.schema(data).parquet(p) if self._exists(p)
              else self.spark.createDataFrame([], data))
        typed = {f.name: f.dataType for f in schema.fields}
        return df.withColumns({k: F.lit(v).cast(typed[k]) for k, v in parts.items()}) \
                 .select(*schema.fieldNames())

    def _at(self, table: str, bk: str | None) -> DataFrame:
        if not bk:
            return self._read(table, with_batch=True).where(F.lit(False))
        return self._folder(table, batch_key=bk)

    def stg(self, entity: str, bk: str | None = None) -> DataFrame:
        bk = bk or self.last_committed()
        return self._at(f"silver_stg_{entity}", bk).drop("batch_key")

    def _base_of(self, bk: str, done: list[str] | None = None) -> tuple[str | None, list[str]]:
        """The newest committed batch up to ``bk`` that has a stored state, and
        the committed batches from there to ``bk``: empty where the batch's own state is
        stored; else those applied with it in bulk, or whose states were dropped.
        ``done``: the committed batches, when the caller knows them."""
        done = self.committed() if done is None else done
        if bk not in done:
            raise ValueError(f"batch {bk} is not committed")
        after: list[str] = []
        for b in reversed([b for b in done if b <= bk]):
            if self._exists(f"{self.path('silver_dim_customers_type1')}/batch_key={b}"):
                return b, after
            after.insert(0, b)
        return None, after

    def _stg_of(self, entity: str, bks: list[str]) -> DataFrame:
        return self._read(f"silver_stg_{entity}", with_batch=True) \
                   .where(F.col("batch_key").isin(bks))

    def dim1(self, bk: str | None = None) -> DataFrame:
        """Type 1 rows as of batch ``bk``; inside a bulk commit they are
        computed from the stored state before it and the staged batches."""
        bk = bk or self.last_committed()
        if not bk:
            return self._at("silver_dim_customers_type1", None).drop("batch_key")
        base, after = self._base_of(bk)
        state = self._at("silver_dim_customers_type1", base).drop("batch_key")
        if after:
            state = self._type1_after(state, base, self._stg_of("customers", after))
        cols = ["customer_id", "name", "city", "update_date"]
        return self._late.state(TYPE1, "customer_id", state, bk, cols)

    @staticmethod
    def _type1_after(prior: DataFrame, last: str | None, stg: DataFrame) -> DataFrame:
        """Type 1: the latest row per key of the earlier state and the batches."""
        inp = prior.select("customer_id", "name", "city", F.col("update_date").alias("event_date"),
                           F.lit(last or "").alias("batch_key")) \
            .unionByName(stg.select("customer_id", "name", "city", "event_date", "batch_key"))
        return scd.scd1_bulk(inp, "customer_id", ["name", "city"], "event_date")

    def _open_versions(self, entity: str, bk: str | None) -> DataFrame:
        """Open versions after a batch with a stored state, corrected keys included."""
        if not bk:
            return self._read(DIM2[entity], with_batch=True).where(F.lit(False))
        stored = self._stored_open(entity, bk)
        columns = [c for c in stored.columns if c != "batch_key"]
        spec = SCD2_SPECS[entity]
        if self._late.history(entity, spec["key"]) is None:
            return stored
        return self._late.state(entity, spec["key"], stored, bk, columns) \
                   .withColumn("batch_key", F.lit(bk)).select(*stored.columns)

    def _stored_open(self, entity: str, bk: str) -> DataFrame:
        folder = f"{self.path(DIM2[entity])}/batch_key={bk}"
        if self.buckets and self._bucketed(f"{folder}/is_current=true"):
            n = self._stored_buckets(entity, bk)
            if n:
                return self._bucketed_open(entity, bk, folder, n)
        return self._folder(DIM2[entity], batch_key=bk, is_current=True)

    def _state_table(self, entity: str, bk: str) -> str:
        import hashlib
        db = "keelson_state_" + hashlib.md5(self.root.encode()).hexdigest()[:10]
        return f"{db}.{DIM2[entity]}_{bk.replace('-', '_')}"

    def _bucketed(self, folder: str) -> bool:
        """Whether a folder holds bucket files (written by a bucketed fold)."""
        import re
        names = [n for n in paths.data_file_names(self.spark, folder) if n.endswith(".parquet")]
        return bool(names) and re.search(r"_\d{5}\.c\d{3}\.", names[0]) is not None

    def _bucket_log(self) -> DataFrame:
        p = f"{self.root}/silver/_bucket_log"
        schema = "entity string, batch_key string, buckets int, at timestamp"
        if not self._exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(p)

    def _stored_buckets(self, entity: str, bk: str) -> int | None:
        """The number of buckets a batch's versions were written with; None
        (read them unbucketed) when it was never logged."""
        mine = (F.col("entity") == F.lit(entity)) & (F.col("batch_key") == F.lit(bk))
        return self._bucket_log().where(mine).agg(F.max_by("buckets", "at")).first()[0]

    def _bucketed_open(self, entity: str, bk: str, folder: str, n: int) -> DataFrame:
        """Open versions of a batch as a bucketed table scan (registered over
        the folder with the ``n`` buckets it was written with, when this
        session does not know it yet)."""
        from keelson.sinks.tables import ensure_table
        spec = SCD2_SPECS[entity]
        name = self._state_table(entity, bk)
        if not self.spark.catalog.tableExists(name):
            ensure_table(self.spark, name, self._schema(DIM2[entity]), ["is_current"], folder,
                         bucket_by=(spec["key"], n))
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return (self.spark.table(name).where(F.col("is_current"))
                .withColumn("batch_key", F.lit(bk)))

    def dim2(self, entity: str, bk: str | None = None) -> DataFrame:
        """Committed versions of a Type 2 dimension as of batch ``bk``.

        A batch inside a bulk commit, or one whose state was dropped, has no folder
        of open versions: its state is the last stored one before it, with the staged
        batches up to ``bk`` applied in one pass (exact across NULLs)."""
        spec = SCD2_SPECS[entity]
        columns = self._schema(DIM2[entity]).fieldNames()
        if bk:
            base, after = self._base_of(bk)
            if after:
                inp = self._bulk_input(entity, base, self._stg_of(entity, after))
                later = scd.scd2_history(inp, spec["key"], spec["tracked"], F.col("__eff"),
                                         self.null_safe)
                # of keys corrected since, the correction alone
                whole = self._closed_rows(entity, base).unionByName(
                    later.withColumn("batch_key", F.coalesce("closed_by", F.lit(bk))).select(*columns, "batch_key"))
                now = whole.where("is_current").select(*columns)
                return self._late.closed(entity, spec["key"], whole.where("not is_current"), bk, columns) \
                           .unionByName(self._late.state(entity, spec["key"], now, bk, columns))
        bk = bk or self.last_committed()
        if not bk:
            return self._closed_rows(entity, None).select(*columns)
        return self._late.closed(entity, spec["key"], self._closed_rows(entity, bk), bk, columns) \
                   .unionByName(self._open_versions(entity, bk).select(*columns))

    def _by_base(self, bks: list[str]) -> tuple[list[str], list[tuple[str | None, list[str], list[str]]]]:
        """Of ``bks`` those whose state is stored, and the others by the stored state that
        they are computed from: (base, its batches, the staged batches to apply)."""
        done, stored, groups = self.committed(), [], {}
        for bk in sorted(bks):
            base, after = self._base_of(bk, done)
            if not after:
                stored.append(bk)
                continue
            mine = groups.setdefault(base, ([], []))
            mine[0].append(bk)
            mine[1][:] = after  # of the newest one: it holds the others'
        return stored, [(base, *g) for base, g in groups.items()]

    def dim2_each(self, entity: str, bks: list[str]) -> DataFrame:
        """``dim2`` after each of ``bks``, with ``as_of``, the batch.

        Batches without a stored state are computed from one history of the staged
        batches since the last stored one, not from one history each."""
        spec = SCD2_SPECS[entity]
        columns = self._schema(DIM2[entity]).fieldNames()
        stored, groups = self._by_base(bks)
        out = [self.dim2(entity, bk).select(F.lit(bk).alias("as_of"), *columns) for bk in stored]
        for base, mine, after in groups:
            inp = self._bulk_input(entity, base, self._stg_of(entity, after))
            whole = scd.scd2_history(inp, spec["key"], spec["tracked"], F.col("__eff"), self.null_safe) \
                       .select(*columns, "opened_by", "closed_by")
            if base:
                whole = whole.unionByName(self._closed_rows(entity, base).select(
                    *columns, F.lit("").alias("opened_by"), F.col("batch_key").alias("closed_by")))
            out.append(self._late.each(entity, spec["key"], whole, mine, columns))
        return reduce(DataFrame.unionByName, out)

    def dim1_each(self, bks: list[str]) -> DataFrame:
        """``dim1`` after each of ``bks``, with ``as_of``, the batch."""
        cols = ["customer_id", "name", "city", "update_date"]
        stored, groups = self._by_base(bks)
        out = [self.dim1(bk).select(F.lit(bk).alias("as_of"), *cols) for bk in stored]
        for base, mine, after in groups:
            prior = self._at("silver_dim_customers_type1", base).select(
                "customer_id", "name", "city", F.col("update_date").alias("event_date"), F.lit(base or "").alias("batch_key"))
            rows = type1_history(prior.unionByName(self._stg_of("customers", after).select(*prior.columns)))
            out.append(self._late.each(TYPE1, "customer_id", rows, mine, [*cols, "is_current"])
                       .where("is_current").drop("is_current"))
        return reduce(DataFrame.unionByName, out)

    def _closed_rows(self, entity: str, bk: str | None) -> DataFrame:
        """Stored versions that batches up to ``bk`` closed (partition filters), with
        ``batch_key``, the batch that did."""
        d = self._read(DIM2[entity], with_batch=True)
        upto = F.col("batch_key") <= F.lit(bk) if bk else F.lit(False)
        return d.where(upto & ~F.col("is_current"))

    def _write_stg(self, entity: str, bks: list[str]) -> DataFrame:
        clean = cleanse.clean_customers if entity == "customers" else cleanse.clean_products
        raw = self.bronze(entity, batch_keys=bks)
        p = self.path(f"silver_stg_{entity}")
        if len(bks) == 1:
            n = overwrite_path(clean(raw).drop("batch_key"), f"{p}/batch_key={bks[0]}")
            self._staged.append(("staged", f"silver_stg_{entity}/{bks[0]}", n))
            return self._folder(f"silver_stg_{entity}", batch_key=bks[0])
        n = overwrite_path(clean(raw), p, ["batch_key"], dynamic=True, rebalance=True)
        self._staged.append(("staged", f"silver_stg_{entity}/{bks[0]}..{bks[-1]}", n))
        return self._read(f"silver_stg_{entity}", with_batch=True) \
                   .where(F.col("batch_key").isin(bks))

    def _bronze_parts(self) -> DataFrame:
        """entity, batch_key, ingest_id, n of the dimension feeds' Bronze partitions."""
        return reduce(DataFrame.unionByName, [
            bronze_parts(self.spark, self.path(f"bronze_raw_{e}"))
            .groupBy(F.lit(e).alias("entity"), "batch_key", "ingest_id").agg(F.sum("n").alias("n"))
            for e in DIM2])

    def _commit(self, bks: list[str]) -> None:
        # a row per Bronze partition of these batches, and one to say that they are noted
        held = {(e, r.batch_key, r.ingest_id) for e in DIM2
                for r in bronze_parts(self.spark, self.path(f"bronze_raw_{e}"))
                .where(F.col("batch_key").isin(bks)).select("batch_key", "ingest_id").collect()}
        mine = self.spark.createDataFrame(sorted(held | {(e, b, -1) for e in DIM2 for b in bks}),
                                          "entity string, batch_key string, ingest_id bigint")
        self._late.note_applied(mine, bks[-1])
        rows = self.spark.createDataFrame([(b,) for b in bks], "batch_key string")
        append_path(rows.withColumn("processed_at", F.current_timestamp()),
                    self.path("silver_batch_control"))

    def apply_batch(self, bk: str, last=_UNKNOWN) -> None:
        """Fold one batch into the dimensions and commit it.  The customer
        chain (stage, Type 1, Type 2) and the product chain run side by side.
        ``last``: the newest committed batch, when the caller knows it."""
        if last is _UNKNOWN:
            last = self.last_committed()

        def customers():
            sc = self._write_stg("customers", [bk]).drop("batch_key")
            prior = self.dim1(last) if last else \
                self._at("silver_dim_customers_type1", None).drop("batch_key")
            d1 = scd.scd1_merge(prior, sc, "customer_id", ["name", "city"], "event_date")
            overwrite_path(d1, f"{self.path('silver_dim_customers_type1')}/batch_key={bk}")
            self._fold_dim2("customers", last, bk, sc, F.col("event_date"))

        def products():
            sp = self._write_stg("products", [bk]).drop("batch_key")
            self._fold_dim2("products", last, bk, sp, F.lit(f"{bk}-01").cast("date"))

        concurrently(customers, products)
        self._commit([bk])

    def _fold_dim2(self, entity: str, last: str | None, bk: str, stg: DataFrame,
                   eff) -> None:
        spec = SCD2_SPECS[entity]
        step = scd.scd2_step(self._open_versions(entity, last), stg, spec["key"],
                             spec["tracked"], eff, self.null_safe)
        self._write_batch_versions(entity, bk, step)

    def _write_batch_versions(self, entity: str, bk: str, versions: DataFrame) -> int:
        """Replace the folder ``batch_key=<bk>`` of a Type 2 dimension with
        ``versions`` (open and closed, split by is_current); bucketed by key
        when the warehouse has ``buckets``."""
        folder = f"{self.path(DIM2[entity])}/batch_key={bk}"
        if not self.buckets:
            return overwrite_path(versions, folder, ["is_current"])
        key = SCD2_SPECS[entity]["key"]
        name = self._state_table(entity, bk)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: metadata only
        row = self.spark.createDataFrame([(entity, bk, self.buckets)],
                                         "entity string, batch_key string, buckets int")
        append_path(row.withColumn("at", F.current_timestamp()),
                    f"{self.root}/silver/_bucket_log/{entity}")  # both chains log at once
        return write_observed(versions, lambda d: d.write.mode("overwrite")
                              .partitionBy("is_current").bucketBy(self.buckets, key)
                              .sortBy(key).option("path", folder).saveAsTable(name))

    def _bulk_input(self, entity: str, last: str | None, stg: DataFrame) -> DataFrame:
        spec = SCD2_SPECS[entity]
        cols = [spec["key"], *spec["tracked"]]
        eff = F.col("event_date") if entity == "customers" else business_date("batch_key")
        new = stg.select(*cols, eff.alias("__eff"), "batch_key")
        prior = self._open_versions(entity, last).select(
            *cols, F.col("valid_from").alias("__eff"), "batch_key")
        return prior.unionByName(new)

    def apply_bulk(self, bks: list[str]) -> None:
        """Apply many pending batches in one pass and commit them together."""
        last, newest = self.last_committed(), bks[-1]
        # what a stopped attempt at these batches left (never committed) goes
        # first: a rerun may write fewer folders than it did
        for name in (*DIM2.values(), "silver_dim_customers_type1"):
            for bk in bks:
                self._drop_folder(f"{self.path(name)}/batch_key={bk}")

        def customers():
            sc = self._write_stg("customers", bks)
            prior1 = self.dim1(last)
            overwrite_path(self._type1_after(prior1, last, sc),
                           f"{self.path('silver_dim_customers_type1')}/batch_key={newest}")
            self._bulk_dim2("customers", last, newest, sc)

        def products():
            self._bulk_dim2("products", last, newest, self._write_stg("products", bks))

        concurrently(customers, products)
        self._commit(bks)

    def _bulk_dim2(self, entity: str, last: str | None, newest: str, stg: DataFrame) -> None:
        spec = SCD2_SPECS[entity]
        inp = self._bulk_input(entity, last, stg)
        v = scd.scd2_history(inp, spec["key"], spec["tracked"], F.col("__eff"), self.null_safe)
        out = v.withColumn("batch_key", F.coalesce("closed_by", F.lit(newest))) \
               .drop("opened_by", "closed_by")
        if not self.buckets:
            overwrite_path(out, self.path(DIM2[entity]), ["batch_key", "is_current"],
                           dynamic=True, rebalance=True)
            return
        # staged once, then: the newest batch's folder (open versions and those
        # it closed) as a bucketed table, the older closed ones as partitions
        stage = f"{self.root}/silver/_scd_stage/{uuid.uuid4().hex[:12]}"
        overwrite_path(out, stage)
        staged = self.spark.read.schema(self._schema(DIM2[entity], with_batch=True)) \
                     .parquet(stage)
        newest_part = F.col("batch_key") == F.lit(newest)
        self._write_batch_versions(entity, newest, staged.where(newest_part).drop("batch_key"))
        overwrite_path(staged.where(~newest_part), self.path(DIM2[entity]),
                       ["batch_key", "is_current"], dynamic=True, rebalance=True)
        self._drop_folder(stage)

    def drop_old_states(self, keep: int) -> int:
        """Remove the stored states (open versions, Type 1 rows) of all but the newest
        ``keep`` committed batches that have one; returns how many went.

        Closed versions and staged batches stay, and with them every batch's state.
        A Type 1 folder is what makes a state count as stored, so it goes first:
        a stop in between leaves folders that no reader follows, and the next
        call removes them."""
        done = self.committed()
        type1 = self.path("silver_dim_customers_type1")
        stored = [b for b in done if self._exists(f"{type1}/batch_key={b}")]
        kept = set(stored[-keep:])
        old = [b for b in done if b not in kept and any(
            self._exists(p) for p in self._state_folders(b))]
        for b in old:
            for p in self._state_folders(b):
                self._drop_folder(p)
        return len(old)

    def _state_folders(self, bk: str) -> list[str]:
        return [f"{self.path('silver_dim_customers_type1')}/batch_key={bk}",
                *[f"{self.path(t)}/batch_key={bk}/is_current=true" for t in DIM2.values()]]

    # ------------------------------------------------------------- late ---
    def late_rows(self) -> DataFrame:
        """Rows that came for a committed batch: entity, batch_key, ingest_id,
        source_file, n, at (when they were recorded)."""
        return self._late.late_rows()

    def record_late(self) -> list[tuple]:
        """Record late files found since the last look: (entity, batch key, rows)."""
        committed = self.control().select("batch_key").distinct()
        new = self._late.late_parts(self._bronze_parts().join(committed, "batch_key", "left_semi"))
        found = new.collect()  # a row per late partition
        out = []
        for e in DIM2:
            mine = [r for r in found if r.entity == e]
            if not mine:
                continue
            rows = self._late_bronze(e, mine).groupBy("batch_key", "ingest_id", "_source_file") \
                       .agg(F.count(F.lit(1)).alias("n"))
            self._late.record(rows.select(F.lit(e).alias("entity"), "batch_key",
                                          F.col("ingest_id").cast("bigint").alias("ingest_id"),
                                          F.col("_source_file").alias("source_file"), "n"))
            out += [(e, b, sum(r.n for r in mine if r.batch_key == b)) for b in sorted({r.batch_key for r in mine})]
        return out

    def _late_bronze(self, entity: str, parts) -> DataFrame:
        """Bronze rows of some (batch_key, ingest_id) partitions, with ``ingest_id``."""
        name = f"bronze_raw_{entity}"
        wanted = self.spark.createDataFrame(sorted({(r.batch_key, r.ingest_id) for r in parts}),
                                            "batch_key string, ingest_id bigint")
        rows = self.spark.read.schema(self._schema(name)).parquet(self.path(name)) \
                   .withColumn("ingest_id", F.col("ingest_id").cast("bigint"))
        here = F.col("ingest_id").isin(sorted({r.ingest_id for r in parts})) \
            & F.col("batch_key").isin(sorted({r.batch_key for r in parts}))
        return rows.where(here).join(F.broadcast(wanted), ["batch_key", "ingest_id"], "left_semi")

    def replay_late(self) -> dict:
        """Rebuild the histories of the keys that recorded late rows touch.

        Only their staged rows are read with the late batches' own (cleansed again with
        the late rows in); the result is a correction, committed by its log row, and
        the late batches are staged anew.  Returns the keys corrected per feed."""
        upto = self.last_committed()
        keys = ["entity", "batch_key", "ingest_id"]
        todo = self.late_rows().select(*keys).distinct().join(self._late.replayed(), keys, "left_anti")
        parts = todo.collect()
        if not parts:
            return {}
        seq, done, counts = self._late.last() + 1, self.committed(), {}
        late_of = {}
        for e in DIM2:
            mine = [r for r in parts if r.entity == e]
            if not mine:
                continue
            key = SCD2_SPECS[e]["key"]
            clean = cleanse.clean_customers if e == "customers" else cleanse.clean_products
            late_of[e] = bks = sorted({r.batch_key for r in mine})
            touched = clean(self._late_bronze(e, mine).drop("ingest_id")).select(key).distinct()
            stage = f"{self.root}/silver/_late_stage/{uuid.uuid4().hex[:12]}"
            counts[e] = overwrite_path(touched, f"{stage}/keys")
            touched = self.spark.read.parquet(f"{stage}/keys")
            others = self._stg_of(e, [b for b in done if b not in bks])
            staged = others.unionByName(clean(self.bronze(e, batch_keys=bks)).select(*others.columns))
            overwrite_path(with_keys(staged, touched, key, "left_semi"), f"{stage}/rows")
            staged = self.spark.read.schema(staged.schema).parquet(f"{stage}/rows")
            eff = F.col("event_date") if e == "customers" else business_date("batch_key")
            self._late.write(seq, e, rebuilt(e, staged, eff, self.null_safe))
            if e == "customers":
                self._late.write(seq, TYPE1, type1_history(staged))
            self._drop_folder(stage)
        self._late.commit(seq, upto, todo)
        for e, bks in late_of.items():
            self._write_stg(e, bks)
        return counts

    def run_silver(self, mode: str = "auto") -> dict:
        """Apply pending batches in order, then bring the fact up to date.

        A batch older than the newest committed one is refused (recorded in
        ``refused_batches``, not applied); the others and the fact go on.
        ``auto`` applies several pending batches in bulk and a single one by a fold;
        the results are the same."""
        self.ensure_control()
        found = self.pending()
        last = self.last_committed()
        refused = [b for b in found if last and b <= last]
        self._refuse(refused, last)
        pend = [b for b in found if b not in refused]
        used = "none"
        if pend:
            use_bulk = mode == "bulk" or (mode == "auto" and len(pend) > 1)
            if use_bulk:
                self.apply_bulk(pend)
                used = "bulk"
            else:
                for bk in pend:
                    self.apply_batch(bk, last)
                    last = bk
                used = "fold"
        self._advance_discovery(found)
        late = self.record_late()
        if self.late == "replay":
            self.replay_late()
        if pend and self.keep_states:
            self.drop_old_states(self.keep_states)
        facts = self.build_fact()
        self._log_run([("pending", b, 1) for b in found] + [("applied", b, 1) for b in pend]
                      + [("refused", b, 1) for b in refused] + self._staged
                      + [("late", f"{e}/{b}", n) for e, b, n in late]
                      + [("fact", "silver_fact_orders", facts), ("batches", "pending", len(found)),
                         ("batches", "applied", len(pend)), ("batches", "refused", len(refused))])
        self._staged = []
        return {"applied": pend, "refused": refused, "mode": used, "fact_rows": facts,
                "late": late}

    def _log_fact(self, phase: str, attempt: int, base: int, upto) -> None:
        self._fact.note(phase, attempt, base, upto)

    def _fact_watermark(self):
        """Ingestion time covered by the fact, or None when it was never built."""
        last = self._fact.last_done()
        return last.upto_ts if last else None

    def build_fact(self, full: bool = False) -> int:
        """Bring the order fact up to date with Bronze; returns rows written.

        First build (or ``full``): restate from all Bronze orders.  Later
        builds read only Bronze rows ingested after the last build (their folders
        alone), find the months that hold the same orders in the locator, merge, and
        write anew only the (year, month) partitions those orders touch.  Keeping the
        first row by a total order is associative, so this equals a full
        restatement.  Rows go to a folder of this attempt; its "done" row commits them.
        """
        last, attempt = self._fact.last_done_and_next()
        obs = Observation()
        if full or last is None:
            src = self.bronze("orders").observe(obs, F.max("_ingestion_ts").alias("upto"))
            self._log_fact("started", attempt, attempt, None)
            n = self._fact.write(cleanse.clean_orders(src), attempt, attempt)
            self._log_fact("done", attempt, attempt, obs.get.get("upto"))
            return n
        src = self.bronze("orders", since=last.upto_ts) if last.upto_ts else self.bronze("orders")
        src = src.observe(obs, F.max("_ingestion_ts").alias("upto"), F.count(F.lit(1)).alias("n"))
        stage = f"{self.root}/silver/_fact_stage/{uuid.uuid4().hex[:12]}"
        overwrite_path(cleanse.clean_orders(src), f"{stage}/new")
        if not obs.get.get("n"):
            self._drop_folder(stage)
            return 0
        cols = ["order_id", "customer_id", "product_id", "amount", "order_date"]
        new = self.spark.read.parquet(f"{stage}/new")
        keys = new.select("order_id")
        # the months that hold these orders (a short list), and those rows in full
        parts = self._fact.current_parts()
        held = self._fact.months_of(keys, parts)
        # the joins broadcast the new order keys only when they fit the threshold, and
        # else shuffle by order_id
        overwrite_path(join_by_size(self._fact.read(held, parts), keys, "order_id", "left_semi"), f"{stage}/old")
        old = self.spark.read.schema(TABLES["silver_fact_orders"][0]).parquet(f"{stage}/old")
        merged = dedup_first(old.select(*cols).unionByName(new.select(*cols)), ["order_id"],
                             cleanse.ORDER_RULE)
        merged = merged.withColumns({"year": F.year("order_date").cast("int"),
                                     "month": F.month("order_date").cast("int")})
        # touched: where the orders were and where they may go (a merged row is one of
        # the old or the new ones); only these partitions are read and written
        touched = sorted(set(held) | {(r[0], r[1]) for r in new.select("year", "month")
                                      .distinct().collect()}, key=repr)
        kept = join_by_size(self._fact.read(touched, parts), keys, "order_id", "left_anti")
        content = kept.unionByName(merged)
        self._log_fact("started", attempt, last.base, None)
        n = self._fact.write(content, attempt, last.base, touched)
        self._log_fact("done", attempt, last.base, obs.get.get("upto"))
        for folder in (stage, *self._fact.replaced_before(attempt, parts)):
            self._drop_folder(folder)
        return n

    def _drop_folder(self, path: str) -> None:
        paths.delete(self.spark, path)

    def fact(self, months=None) -> DataFrame:
        """The fact as of the last finished build (``months``: only those partitions)."""
        return self._fact.read(months)

    # ------------------------------------------------------------- gold ---
    def current_versions(self, entity: str) -> DataFrame:
        """The current rows of a Type 2 dimension: the open versions of the
        newest committed batch, one folder (bucketed when stored so), no
        closed history scanned."""
        return self._open_versions(entity, self.last_committed()).drop("batch_key")

    def _gold_log(self) -> DataFrame:
        p = f"{self.root}/gold/_gold_log"
        schema = "phase string, state string, counts map<string,bigint>, at timestamp"
        if not self._exists(p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(p)

    def _gold_state(self, as_of, k: int) -> str:
        """What the marts depend on: their arguments, the newest committed
        batch, and the ingestion time that the fact covers."""
        return "|".join(map(str, (as_of or dt.date.today(), k, self.last_committed(),
                                  self._fact_watermark(), self._late.last())))

    def _log_gold(self, phase: str, state: str, counts: dict) -> None:
        row = self.spark.createDataFrame(
            [(phase, state, counts)], "phase string, state string, counts map<string,bigint>")
        append_path(row.withColumn("at", F.current_timestamp()), f"{self.root}/gold/_gold_log")

    def gold_counts(self, as_of=None, k: int = 100) -> dict | None:
        """Rows of the marts as last built, if that build finished on the present
        state of Silver and for these arguments; else None."""
        last = self._gold_log().orderBy(F.col("at").desc()).limit(1).collect()
        if last and last[0].phase == "done" and last[0].state == self._gold_state(as_of, k):
            return dict(last[0].counts)
        return None

    def run_gold(self, as_of=None, k: int = 100) -> dict:
        """Rebuild the marts from the fact and the current dimension rows."""
        state = self._gold_state(as_of, k)
        self._log_gold("started", state, {})
        fact = self.fact()
        dc, dp = self.current_versions("customers"), self.current_versions("products")
        # one pass over the fact gives the per-customer and per-product totals
        # all three marts start from; staged (a row per key), so the marts do
        # not scan the fact again
        stage = f"{self.root}/gold/_totals"
        overwrite_path(marts.per_key_totals(fact), stage)
        per = self.spark.read.parquet(stage)
        pc, pp = marts.totals_of(per, "customer_id"), marts.totals_of(per, "product_id")
        outs = {
            "gold_agg_sales_by_city": marts.sales_by_city(fact, dc, as_of, totals=pc),
            "gold_agg_sales_by_category": marts.sales_by_category(fact, dp, as_of, totals=pp),
            "gold_ranking_customers": marts.customer_ranking(fact, dc, k, totals=pc),
        }
        names = list(outs)
        counts = concurrently(*[
            (lambda n: lambda: overwrite_path(outs[n].select(*TABLES[n][0].fieldNames()),
                                              self.path(n)))(n) for n in names])
        built = dict(zip(names, counts))
        self._log_gold("done", state, built)
        self._log_run([("gold", n, c) for n, c in built.items()])
        return built

    # ---------------------------------------------------------- readers ---
    def table(self, name: str) -> DataFrame:
        """The committed content of any of the 13 tables."""
        if name.startswith("bronze_raw_"):
            return self.bronze(name[len("bronze_raw_"):])
        if name == "silver_stg_customers":
            return self.stg("customers")
        if name == "silver_stg_products":
            return self.stg("products")
        if name == "silver_dim_customers_type1":
            return self.dim1()
        if name == "silver_dim_customers_type2":
            return self.dim2("customers")
        if name == "silver_dim_products_type2":
            return self.dim2("products")
        if name == "silver_batch_control":
            return self.control()
        if name == "silver_fact_orders":
            return self.fact()
        return self._read(name)

    def register_views(self) -> None:
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)

    PLAIN = ("silver_batch_control", "gold_agg_sales_by_city",
             "gold_agg_sales_by_category", "gold_ranking_customers")

    def register_catalog(self, db_prefix: str = "keelson") -> list[str]:
        """Declare every table that has been written in the session's catalog,
        for any session that shares it.

        Control and gold are Parquet tables over their folders.  Bronze and the fact are
        declared as ``<name>_files`` and the tables kept per batch as
        ``<name>_batches``; under their own name there is a stored view of
        their committed content.  Partitions are recovered here: call it
        again after new batches (a session that read the tables before must
        refresh them)."""
        from keelson.sinks.tables import ensure_table
        names = []
        control = f"{db_prefix}_silver.silver_batch_control"
        newest = f"(SELECT MAX(batch_key) FROM {control})"
        for name, (schema, parts) in TABLES.items():
            if not self._exists(self.path(name)):
                continue
            full = f"{db_prefix}_{name.split('_', 1)[0]}.{name}"
            names.append(full)
            if name.startswith("bronze_"):
                from pyspark.sql import types as T
                files, layout = f"{full}_files", ["ingest_id", *parts]
                stored = T.StructType([*schema.fields, T.StructField("ingest_id", T.LongType())])
                ensure_table(self.spark, files, stored, layout, self.path(name))
                self.spark.sql(f"ALTER TABLE {files} RECOVER PARTITIONS")
                self.spark.catalog.refreshTable(files)
                last = bronze_parts(self.spark, self.path(name)).agg(F.max("ingest_id")).first()[0]
                self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {', '.join(schema.fieldNames())} "
                               f"FROM {files} WHERE ingest_id <= {-1 if last is None else last}")
                continue
            if name == "silver_fact_orders":
                from pyspark.sql import types as T
                files = f"{full}_files"
                stored = T.StructType([*schema.fields, T.StructField("attempt", T.LongType())])
                ensure_table(self.spark, files, stored, ["attempt", *parts], self.path(name))
                self.spark.sql(f"ALTER TABLE {files} RECOVER PARTITIONS")
                self.spark.catalog.refreshTable(files)
                held = " OR ".join(f"(attempt = {a} AND year <=> {'NULL' if y is None else y} "
                                   f"AND month <=> {'NULL' if m is None else m})"
                                   for (y, m), a in self._fact.current_parts().items()) or "FALSE"
                self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT "
                               f"{', '.join(schema.fieldNames())} FROM {files} WHERE {held}")
                continue
            if name in self.PLAIN:
                ensure_table(self.spark, full, schema, parts, self.path(name))
                if parts:
                    self.spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
                self.spark.catalog.refreshTable(full)
                continue
            two = name in DIM2.values()
            ensure_table(self.spark, f"{full}_batches", self._schema(name, with_batch=True),
                         ["batch_key", "is_current"] if two else ["batch_key"], self.path(name))
            self.spark.sql(f"ALTER TABLE {full}_batches RECOVER PARTITIONS")
            self.spark.catalog.refreshTable(f"{full}_batches")
            cols = ", ".join(c for c in schema.fieldNames() if c != "batch_key")
            kept = f"batch_key = {newest}"
            if two:
                kept = f"({kept} AND is_current) OR (batch_key <= {newest} AND NOT is_current)"
            ensure_table(self.spark, control, *TABLES["silver_batch_control"],
                         self.path("silver_batch_control"))
            self.spark.sql(f"CREATE OR REPLACE VIEW {full} AS "
                           f"SELECT {cols} FROM {full}_batches WHERE {kept}")
        return names

    def ensure_control(self) -> None:
        """Create the (empty) control table if it does not exist yet."""
        p = self.path("silver_batch_control")
        if not self._exists(p):
            overwrite_path(self.spark.createDataFrame([], TABLES["silver_batch_control"][0]), p)

    def run(self, landing_root: str, as_of=None, mode: str = "auto",
            ingest_ts: dt.datetime | None = None) -> dict:
        """Bronze, then Silver, then Gold; a rerun with no new file is a no-op.

        The marts are rebuilt unless their last build finished on the present
        state of Silver and for this date."""
        report = {"ingested": self.ingest(landing_root, ingest_ts)}
        report["silver"] = self.run_silver(mode)
        done = self.gold_counts(as_of)
        report["gold"] = self.run_gold(as_of) if done is None else done
        return report
