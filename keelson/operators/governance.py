"""Row and column restricted views of a table (the analyst's view).

A DataFrame operator, not access control: it decides what a consumer of the
returned frame sees, e.g. only current versions and no history columns.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

HISTORY_COLUMNS = ("valid_from", "valid_to", "is_current")


def analyst_view(df: DataFrame, row_filter: Column | str | None = "is_current",
                 exclude: Sequence[str] = HISTORY_COLUMNS) -> DataFrame:
    out = df
    if row_filter is not None:
        out = out.where(F.col(row_filter) if isinstance(row_filter, str) else row_filter)
    return out.drop(*[c for c in exclude if c in out.columns])
