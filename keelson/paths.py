"""Folder checks on the cluster's file system (local, HDFS, object stores).

PySpark has no Python file-system API, so these go through Hadoop's
``FileSystem`` for the path's scheme, as Spark itself does.  Only names
and existence are looked at, folders removed or renamed; no file is read here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def _is_data(name: str) -> bool:
    return not name.startswith(("_", "."))


def part(v) -> str:
    """Folder value of a partition column (NULL and '' have Spark's default name)."""
    return "__HIVE_DEFAULT_PARTITION__" if v in (None, "") else str(v)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and its content, if present."""
    p, fs = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; ``target`` must not exist yet, the folders above it are made."""
    p, fs = _fs(spark, source)
    to, _ = _fs(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def data_file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files directly in ``folder`` (no hidden or
    underscore files, no subfolders)."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)
            if st.isFile() and _is_data(st.getPath().getName())]


def has_data_file(spark: SparkSession, folder: str) -> bool:
    """Whether any data file lies under ``folder`` (stops at the first)."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        if _is_data(it.next().getPath().getName()):
            return True
    return False
