"""Write raw feed rows as source files (a landing zone), for loads and tests.

Rows are grouped into one folder per source file name taken from
``_source_file`` (``src=customers_1995-01.json/part-*.json``), so each batch
key appears in the path of the files that hold its rows.  Rows are dealt by
source file before they are written (``REBALANCE``: large ones are split), so
the number of files follows the bytes, not tasks times source files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelson import paths

EXT = {"customers": "json", "products": "csv", "orders": "parquet"}


def land(df: DataFrame, root: str, entity: str, fmt: str | None = None,
         mode: str = "append", by: Sequence[str] = ()) -> str:
    """Write ``df`` (raw columns + _source_file) under ``root/entity``; with columns ``by``
    into a folder for each of their values (waves that arrive later, see ``arrive``)."""
    fmt = fmt or EXT[entity]
    path = f"{root.rstrip('/')}/{entity}"
    out = (df.withColumn("src", F.regexp_extract("_source_file", r"([^/]+)$", 1))
           .drop("_source_file").hint("rebalance", *by, "src"))
    w = out.write.mode(mode).partitionBy(*by, "src")
    if fmt == "csv":
        w = w.option("header", True).option("sep", ",")
    w.format(fmt).save(path)
    return path


def arrive(spark: SparkSession, waiting: str, root: str, entity: str, folder: str) -> bool:
    """Move the files of a wave, written under ``waiting/entity/folder``, into the landing
    zone ``root``; False where the wave has none."""
    source = f"{waiting.rstrip('/')}/{entity}/{folder}"
    if not paths.exists(spark, source):
        return False
    paths.move(spark, source, f"{root.rstrip('/')}/{entity}/{folder}")
    return True
