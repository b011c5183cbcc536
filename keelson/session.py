"""Session construction and the shared folder used for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the warehouse's jobs rely on.  On a cluster, a value the
# submission already set explicitly is kept; these fill in only what is unset.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # batch keys such as 1995-01 must stay strings when a folder is read
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# Only for a session this process starts itself (tests, bench).
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "keelson",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the warehouse's settings.

    With ``master`` (a local run) every setting is applied.  Without it (a
    cluster submission) a setting is applied only where the submission left
    it unset; ``shuffle_partitions`` and ``extra`` are always applied.
    """
    b = SparkSession.builder.appName(app)
    forced = dict(extra or {})
    if shuffle_partitions:
        forced["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:
        b = b.master(master)
        for k, v in {**LOCAL_CONF, **BASE_CONF, **forced}.items():
            b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in BASE_CONF.items():
        # get(k, None) is None only when neither the submission nor the
        # session set the key (a default value does not count)
        if master or spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    for k, v in forced.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # a static setting of a running session
            pass
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    It is read from the session; only a local session without one gets a
    fresh folder of its own (as in tests).  A cluster without the setting
    is an error: a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            d = None
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
        d = tempfile.mkdtemp(prefix="keelson-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # not settable on this session: the context dir below
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder, unique per call."""
    root = shared_dir(spark)
    p = f"{root}/keelson/{purpose}-{uuid.uuid4().hex[:12]}"
    if p.startswith("/") or p.startswith("file:"):
        os.makedirs(p.replace("file:", "", 1), exist_ok=True)
    return p
