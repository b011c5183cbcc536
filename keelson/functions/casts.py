"""Lenient casts: a value that does not parse becomes NULL instead of
failing the job (Spark 4 runs with ANSI mode on, where CAST raises)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c) -> Column:
    return _c(c).try_cast("int")


def lenient_long(c) -> Column:
    return _c(c).try_cast("bigint")


def lenient_double(c) -> Column:
    return _c(c).try_cast("double")


def lenient_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict pattern parse: '2026-1-5' and '2026-01-05 10:00' give NULL."""
    return F.try_to_date(_c(c), fmt)


def lenient_date_any(c) -> Column:
    """Parse without a pattern: a trailing time part is accepted and dropped."""
    return _c(c).try_cast("date")
