"""Keep one row per key, chosen by a total order.

Spark's ``dropDuplicates`` keeps an arbitrary row.  Here the kept row is the
first under an explicit order, so reruns give the same table.  It is an
aggregate (``min`` of a struct), not a window: the aggregate is combined on
the map side, so a key that holds a large share of all rows is reduced to
one row per task before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_EPOCH = "1970-01-01"


def _asc_key(name: str, dtype: str, desc: bool) -> list[Column]:
    c = F.col(name)
    if not desc:
        return [c]  # ascending, NULL first (as in Spark's ORDER BY)
    # descending with NULL last: a null flag first, then the negated value
    if dtype == "date":
        v = -F.unix_date(c)
    elif dtype in ("int", "bigint", "double", "float", "smallint", "tinyint") or \
            dtype.startswith("decimal"):
        v = -c
    elif dtype == "timestamp":
        v = -F.unix_micros(c)
    else:
        raise TypeError(f"descending order on {dtype} is not supported: {name}")
    return [c.isNull(), v]


def dedup_first(df: DataFrame, keys: Sequence[str],
                order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row per ``keys``: the first under ``order`` = [(column, descending)].

    Columns not named in ``order`` break remaining ties, so the choice is
    total.  The output has the input's columns in the input's order.
    """
    types = dict(df.dtypes)
    ordered = [c for c, _ in order]
    rest = [c for c in df.columns if c not in keys and c not in ordered]
    sort_fields: list[Column] = []
    for i, (name, desc) in enumerate(order):
        for j, e in enumerate(_asc_key(name, types[name], desc)):
            sort_fields.append(e.alias(f"__o{i}_{j}"))
    payload = [F.col(c).alias(c) for c in ordered + rest]
    best = F.min(F.struct(*sort_fields, *payload)).alias("__best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"__best.{c}").alias(c) for c in ordered + rest]) \
              .select(*df.columns)
