"""Batch keys: the YYYY-MM token a raw file carries in its path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The last YYYY-MM token (month 01-12) of a path that stands on its own,
# i.e. is not glued to other letters or digits.  Taking the last one makes
# `2026-01/customers_2026-02.json` belong to 2026-02, and the guards keep
# hex runs of generated part-file names from being read as a date.
BATCH_TOKEN_RE = r"^.*(?<![0-9A-Za-z])([0-9]{4}-(?:0[1-9]|1[0-2]))(?![0-9A-Za-z])"


def batch_key_of(path) -> Column:
    """Batch key of a file path; '' when the path carries no token."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, BATCH_TOKEN_RE, 1)


def business_date(batch_key) -> Column:
    """First day of the batch month, as a DATE."""
    bk = F.col(batch_key) if isinstance(batch_key, str) else batch_key
    return F.to_date(F.concat(bk, F.lit("-01")), "yyyy-MM-dd")
