"""Size checks before choosing a broadcast.

A side is broadcast only when the optimizer's size estimate of its plan and
its rows at full width are under the session's
``spark.sql.autoBroadcastJoinThreshold``; beyond it the caller keeps a shuffle
join.  The estimate alone does not do: for a scan it is the size of the
files, and rows of few distinct values take twenty times as much in memory.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

# The size suffixes Spark accepts in byte settings (binary
# multiples; a bare number is bytes).
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def byte_setting(text: str | None) -> int:
    """A byte-size setting as written in a Spark conf ('10485760b', '64m',
    '-1') in bytes; an unreadable value gives 0 (no broadcast)."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([A-Za-z]*)\s*", text or "")
    if not m or m.group(2).lower() not in _UNITS:
        return 0
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` (file sizes for a scan)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size if isinstance(size, int) else int(str(size.toString()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (<= 0: broadcast off)."""
    return byte_setting(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def row_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df`` in memory, by their number and their types'
    default sizes.  Of a stored table the count reads file footers alone."""
    return df.count() * (8 + df._jdf.schema().defaultSize())


def fits_broadcast(df: DataFrame) -> bool:
    """True only when both sizes are known and under the threshold; an
    unknown size keeps the shuffle join.  Rows are counted only where the
    estimate is under it."""
    try:
        limit = broadcast_limit(df)
        return 0 < limit and estimated_bytes(df) <= limit and row_bytes(df) <= limit
    except Exception:  # no optimizer statistics available from this session
        return False


def join_by_size(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """A join (left, semi or anti) that broadcasts ``right`` only when it fits,
    and else sorts and merges, so that Spark does not broadcast it for the
    size of its files."""
    side = F.broadcast(right) if fits_broadcast(right) else right.hint("merge")
    return left.join(side, on, how)
