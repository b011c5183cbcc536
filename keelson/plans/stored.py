"""Pipeline runs over landed feeds, shared by the registered queries.

``full_run``: land the three feeds, ingest, fold every batch one at a time,
build fact and gold, then run everything again (no new file: a no-op).

``staged_run``: the feeds arrive in two waves.  The first (batches up to
``WAVE_SPLIT``) is ingested and applied in one bulk pass; the second is
ingested, listed as pending, and folded batch by batch on top (versions
stored bucketed by key); a last ingest finds nothing new.  Together they exercise exactly-once pick-up,
bulk and fold on one history, and the commit log.

``stopped_run``: as ``staged_run``, but the process "dies" once in every step
(before a bulk commit, while the fact is rewritten, before a folded batch's
commit, before a mart's build is logged) and the step is run again.

``late_run``: some rows of two early batches come only after later batches were committed
(some in bulk, some folded); they are recorded and replayed, then a last batch is folded.

``types_run``: the orders feed as Parquet files of three type layouts, in two waves.

``rewriting_run``: a second wave's fact build stops after writing its rows, before its commit.

Runs are kept per session and input folder, as several queries read the
same warehouse.  Everything is written under the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from keelson.plans import flows
from keelson.plans.warehouse import ENTITIES, Warehouse, concurrently
from keelson.session import scratch_path
from keelson.sources import feeds
from keelson.sources.landing import arrive, land

# Fixed value: the second arrival wave starts after this batch key.
WAVE_SPLIT = "1999-01"
BUCKETS = 8

_RUNS: dict[tuple, dict] = {}


def _key(spark: SparkSession, sf_dir: str, variant: str) -> tuple:
    return (id(spark.sparkContext), sf_dir.rstrip("/"), variant)


def in_waves(spark: SparkSession, sf_dir: str, root: str, wave, entities=ENTITIES):
    """Write the feeds' files once, by the wave (``wave(entity)``, a column over the raw rows
    and ``batch_key``) that brings them, outside ``root/landing``.  Returns a function that
    lets a wave arrive there: a feed is derived once, not once a wave.  A row that names
    no source file is in no wave."""
    def put(e):
        rows = flows.bronze(spark, sf_dir, e).where(F.col("_source_file").isNotNull())
        land(rows.withColumn("arrival", wave(e)).drop("batch_key"), f"{root}/waiting", e, by=["arrival"])

    concurrently(*[lambda e=e: put(e) for e in entities])

    def come(n: int) -> None:
        for e in entities:
            arrive(spark, f"{root}/waiting", f"{root}/landing", e, f"arrival={n}")
    return come


def _second_wave(entity: str) -> Column:
    return (F.col("batch_key") > F.lit(WAVE_SPLIT)).cast("int")


def full_run(spark: SparkSession, sf_dir: str) -> dict:
    k = _key(spark, sf_dir, "full")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_path(spark, "wh-full")
    landing = f"{root}/landing"
    for e in ("customers", "products", "orders"):
        land(feeds.raw_feed(spark, sf_dir, e), landing, e)
    wh = Warehouse(spark, f"{root}/warehouse")
    first = wh.run(landing, as_of=flows.AS_OF, mode="fold")
    again = wh.run(landing, as_of=flows.AS_OF, mode="fold")
    _RUNS[k] = {"wh": wh, "first": first, "again": again, "landing": landing}
    return _RUNS[k]


def staged_run(spark: SparkSession, sf_dir: str) -> dict:
    k = _key(spark, sf_dir, "staged")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_path(spark, "wh-staged")
    landing = f"{root}/landing"
    # the folded batches store their versions bucketed by key (BUCKETS), so a
    # later batch's join reads them without a shuffle
    wh = Warehouse(spark, f"{root}/warehouse", buckets=BUCKETS)
    come = in_waves(spark, sf_dir, root, _second_wave)
    come(0)
    wave1 = wh.ingest(landing)
    silver1 = wh.run_silver(mode="auto")
    come(1)
    wave2 = wh.ingest(landing)
    pending = wh.pending()
    silver2 = wh.run_silver(mode="fold")
    wave3 = wh.ingest(landing)
    _RUNS[k] = {"wh": wh, "ingested": [wave1, wave2, wave3], "pending": pending,
                "silver": [silver1, silver2]}
    return _RUNS[k]


# The batches whose late rows arrive after later commits, the batch
# folded before them and the last one, folded after them.
LATE_CUSTOMERS, LATE_PRODUCTS, LATE_AFTER, LAST = "1997-01", "1998-01", "2000-01", "2001-01"


def is_late(entity: str) -> Column:
    """Raw rows (with ``batch_key``) that ``late_run`` holds back."""
    if entity == "customers":
        return (F.col("batch_key") == LATE_CUSTOMERS) & F.coalesce(F.col("customer_id").try_cast("bigint") % 7 == 3, F.lit(False))
    if entity == "products":
        return (F.col("batch_key") == LATE_PRODUCTS) & F.coalesce(F.substring("product_id", 2, 20).try_cast("bigint") % 6 == 2, F.lit(False))
    return F.lit(False)


def late_wave(entity: str) -> Column:
    """0: up to WAVE_SPLIT, 1: up to LATE_AFTER, 2: the late rows, 3: the rest."""
    bk = F.col("batch_key")
    in_time = (bk > F.lit(WAVE_SPLIT)).cast("int") + 2 * (bk > F.lit(LATE_AFTER)).cast("int")
    return F.when(is_late(entity), F.lit(2)).otherwise(in_time)


def late_run(spark: SparkSession, sf_dir: str) -> dict:
    k = _key(spark, sf_dir, "late")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_path(spark, "wh-late")
    landing = f"{root}/landing"
    wh = Warehouse(spark, f"{root}/warehouse", late="replay")
    come = in_waves(spark, sf_dir, root, late_wave)
    reports = []
    for wave in range(4):
        come(wave)
        wh.ingest(landing)
        reports.append(wh.run_silver(mode="auto"))
    _RUNS[k] = {"wh": wh, "silver": reports}
    return _RUNS[k]


def types_run(spark: SparkSession, sf_dir: str) -> dict:
    """Orders as files of strings, of BIGINT ids with typed amounts and dates, and of INT
    ids; the first two in one run, the third in a later one with more strings."""
    k = _key(spark, sf_dir, "types")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_path(spark, "wh-types")
    wh = Warehouse(spark, f"{root}/warehouse")
    raw = feeds.raw_feed(spark, sf_dir, "orders")
    typed = F.col("order_id").try_cast("bigint").isNotNull()
    group = F.when(typed, F.col("order_id").try_cast("bigint") % 4).otherwise(0)

    def put(name: str, g: int, ids: str | None) -> None:
        df = raw.where(group == g).drop("_source_file")
        if ids:
            df = df.withColumns({"order_id": F.col("order_id").cast(ids), "customer_id": F.col("customer_id").cast(ids),
                                 "amount": F.col("amount").cast("double"), "order_date": F.col("order_date").cast("date")})
        df.write.mode("append").parquet(f"{root}/landing/orders/{name}")

    rows = []
    for wave in ([("orders_1996-01", 0, None), ("orders_1997-01", 1, "bigint")],
                 [("orders_1998-01", 2, "int"), ("orders_1999-01", 3, None)]):
        for name, g, ids in wave:
            put(name, g, ids)
        rows.append(wh.ingest(f"{root}/landing")["orders"])
        wh.build_fact()
    _RUNS[k] = {"wh": wh, "ingested": rows}
    return _RUNS[k]


class _Stop(Exception):
    pass


class _StoppingWarehouse(Warehouse):
    """Stops once at the named step, just before it would be recorded."""

    stop: str | None = None

    def _reach(self, step: str) -> None:
        if self.stop == step:
            self.stop = None
            raise _Stop(step)

    def _commit(self, bks):
        self._reach("commit")
        super()._commit(bks)

    def _log_fact(self, phase, attempt, base, upto):
        if phase == "done":
            self._reach("fact")
        super()._log_fact(phase, attempt, base, upto)

    def _log_gold(self, phase, state, counts):
        if phase == "done":
            self._reach("gold")
        super()._log_gold(phase, state, counts)


def stopped_run(spark: SparkSession, sf_dir: str) -> dict:
    k = _key(spark, sf_dir, "stopped")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_path(spark, "wh-stopped")
    landing = f"{root}/landing"
    wh = _StoppingWarehouse(spark, f"{root}/warehouse")
    stops = []

    def attempt(step: str, job) -> None:
        wh.stop = step
        try:
            job()
        except _Stop:
            stops.append(step)

    come = in_waves(spark, sf_dir, root, _second_wave)
    for wave, mode in ((0, "bulk"), (1, "fold")):
        come(wave)
        wh.ingest(landing)
        attempt("commit", lambda: wh.run_silver(mode=mode))  # noqa: B023  run at once
        attempt("fact", lambda: wh.run_silver(mode=mode))  # noqa: B023
        wh.run_silver(mode=mode)
        attempt("gold", lambda: wh.run_gold(as_of=flows.AS_OF))
        wh.run_gold(as_of=flows.AS_OF)
    _RUNS[k] = {"wh": wh, "stops": stops}
    return _RUNS[k]


def rewriting_run(spark: SparkSession, sf_dir: str) -> dict:
    k = _key(spark, sf_dir, "rewriting")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_path(spark, "wh-rewriting")
    landing = f"{root}/landing"
    wh = _StoppingWarehouse(spark, f"{root}/warehouse")
    come = in_waves(spark, sf_dir, root, _second_wave, ["orders"])
    for wave in (0, 1):
        come(wave)
        wh.ingest(landing)
        if wave == 0:
            wh.build_fact()
    wh.stop = "fact"
    try:
        wh.build_fact()
    except _Stop:
        _RUNS[k] = {"wh": wh}
        return _RUNS[k]
    raise AssertionError("the build did not stop")
