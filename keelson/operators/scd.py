"""Slowly changing dimensions without MERGE.

Type 1 keeps the last value per key; Type 2 keeps version rows with a
half-open validity interval ``[valid_from, valid_to)`` and ``is_current``.

Two ways to build Type 2:

* the **fold** applies one batch to the open versions (``scd2_step``): one
  full outer join of open versions with the batch, whose output holds both
  the versions it closes and the versions left open.  It costs O(open +
  batch) and never touches closed history.
* the **bulk** form (``scd2_bulk``) builds the versions of many batches in
  one pass: ``lag`` over each key's rows in batch order keeps the rows that
  change a tracked column, ``lead`` closes them.  A key has at most one row
  per batch, so a window partition never holds more rows than there are
  batches, whatever the skew of the raw feed.

Both compare tracked columns with ``<>`` by default, so NULL against a value
is *not* a change (the reference semantics); ``null_safe=True`` counts it.
The bulk form equals the fold when tracked columns hold no NULL, or when
``null_safe=True`` (the fold compares with the last accepted version, the
bulk with the last seen row; they differ only across NULLs).  ``scd2_history``
is a one-pass form that equals the fold always: an ordered fold of each key's
rows inside one aggregate.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def differs(a: Column, b: Column, null_safe: bool) -> Column:
    return ~a.eqNullSafe(b) if null_safe else (a != b)


def any_differs(pairs: Sequence[tuple[Column, Column]], null_safe: bool) -> Column:
    return reduce(or_, [differs(a, b, null_safe) for a, b in pairs])


# ----------------------------------------------------------------- Type 1 --

def scd1_merge(dim: DataFrame, stg: DataFrame, key: str, attrs: Sequence[str],
               date_col: str) -> DataFrame:
    """Upsert: keys in the batch take the batch's values, others stay.

    Exact replacement of a MERGE whose matched branch sets every column.
    Output: key, attrs..., update_date.  The batch's keys are broadcast when
    their estimated size fits the threshold, so the dimension is not shuffled.
    """
    from keelson.operators.sizing import join_by_size
    upd = stg.select(key, *attrs, F.col(date_col).alias("update_date"))
    kept = join_by_size(dim.select(key, *attrs, "update_date"), upd.select(key), key, "left_anti")
    return kept.unionByName(upd)


def scd1_bulk(stg: DataFrame, key: str, attrs: Sequence[str], date_col: str,
              order_col: str = "batch_key") -> DataFrame:
    """Type 1 after many batches at once: the row of each key's latest batch.

    An aggregate (max of a struct led by the batch key), so it is combined
    on the map side.
    """
    best = F.max(F.struct(F.col(order_col).alias("__b"), *[F.col(a) for a in attrs],
                          F.col(date_col).alias("update_date"))).alias("__m")
    return (stg.groupBy(key).agg(best)
            .select(key, *[F.col(f"__m.{a}").alias(a) for a in attrs],
                    F.col("__m.update_date").alias("update_date")))


# ----------------------------------------------------------------- Type 2 --

def scd2_changes(dim: DataFrame, stg: DataFrame, key: str, tracked: Sequence[str],
                 null_safe: bool = False) -> DataFrame:
    """Batch rows that open a version: the key has no current version, or a
    tracked column differs from it.  Output: the batch rows as given."""
    cur = (dim.where(F.col("is_current"))
           .select(key, F.lit(True).alias("__cur"),
                   *[F.col(t).alias(f"__c_{t}") for t in tracked]))
    j = stg.join(cur, key, "left")
    cond = F.col("__cur").isNull() | any_differs(
        [(F.col(t), F.col(f"__c_{t}")) for t in tracked], null_safe)
    return j.where(cond).select(*stg.columns)


def _version(key: Column, attrs: list[Column], frm: Column, to: Column,
             cur: Column) -> Column:
    return F.struct(key.alias("k"), *[a.alias(f"a{i}") for i, a in enumerate(attrs)],
                    frm.alias("valid_from"), to.alias("valid_to"), cur.alias("is_current"))


def scd2_step(open_versions: DataFrame, stg: DataFrame, key: str, tracked: Sequence[str],
              effective: Column, null_safe: bool = False,
              small_batch: bool | None = None) -> DataFrame:
    """Apply one batch to the open versions of a Type 2 dimension.

    ``open_versions``: key, tracked..., valid_from (the current rows).
    ``stg``: one row per key of the batch; ``effective`` is the change date
    evaluated on it (a column such as event_date, or a literal date).
    Returns the versions left open (``is_current``) and those closed by this
    batch (``valid_to`` = the change date), in one pass.

    A batch whose estimated size fits the broadcast threshold (or
    ``small_batch=True``) is broadcast: every open version meets its batch
    row in a broadcast left join, and new keys are the batch rows missing
    from the (small) set of open versions the batch touches, so the
    dimension is scanned but never shuffled.  A larger batch takes one full
    outer join, shuffling both sides by key.
    """
    cur = open_versions.select(key, F.lit(True).alias("__cur"),
                               *[F.col(t).alias(f"__c_{t}") for t in tracked],
                               F.col("valid_from").alias("__c_from"))
    new = stg.select(key, F.lit(True).alias("__new"),
                     *[F.col(t).alias(f"__n_{t}") for t in tracked],
                     effective.alias("__eff"))
    if small_batch is None:
        from keelson.operators.sizing import fits_broadcast
        small_batch = fits_broadcast(stg)
    if small_batch:
        b_new = F.broadcast(new)
        a = cur.join(b_new, key, "left")
        touched = cur.select(key).join(F.broadcast(new.select(key)), key, "left_semi")
        fresh = new.join(touched, key, "left_anti")
        fresh = fresh.select(key, F.lit(None).cast("boolean").alias("__cur"),
                             *[F.lit(None).cast(dict(cur.dtypes)[f"__c_{t}"]).alias(f"__c_{t}")
                               for t in tracked],
                             F.lit(None).cast("date").alias("__c_from"),
                             "__new", *[f"__n_{t}" for t in tracked], "__eff")
        j = a.unionByName(fresh)
    else:
        j = cur.join(new, key, "full_outer")
    has_cur = F.col("__cur").isNotNull()
    changed = F.coalesce(
        F.col("__new").isNotNull() & (~has_cur | any_differs(
            [(F.col(f"__n_{t}"), F.col(f"__c_{t}")) for t in tracked], null_safe)),
        F.lit(False))
    k = F.col(key)
    old_attrs = [F.col(f"__c_{t}") for t in tracked]
    new_attrs = [F.col(f"__n_{t}") for t in tracked]
    no_date = F.lit(None).cast("date")
    closed = F.when(changed & has_cur,
                    _version(k, old_attrs, F.col("__c_from"), F.col("__eff"), F.lit(False)))
    opened = (F.when(changed, _version(k, new_attrs, F.col("__eff"), no_date, F.lit(True)))
              .when(has_cur, _version(k, old_attrs, F.col("__c_from"), no_date, F.lit(True))))
    rows = j.select(F.explode(F.filter(F.array(closed, opened), lambda v: v.isNotNull()))
                    .alias("v"))
    return rows.select(F.col("v.k").alias(key),
                       *[F.col(f"v.a{i}").alias(t) for i, t in enumerate(tracked)],
                       "v.valid_from", "v.valid_to", "v.is_current")


def scd2_bulk(stg: DataFrame, key: str, tracked: Sequence[str], effective: Column,
              null_safe: bool = False, order_col: str = "batch_key",
              keep_order_col: bool = False) -> DataFrame:
    """Type 2 versions of all batches in ``stg`` in one pass.

    ``stg`` holds at most one row per key and batch.  A row opens a version
    when it is the key's first or a tracked column differs from the key's
    previous row; the next version's start closes it.
    Output: key, tracked..., valid_from, valid_to, is_current
    (+ ``order_col`` and ``closed_by``, the batch that closed the version,
    when ``keep_order_col``).
    """
    w = Window.partitionBy(key).orderBy(order_col)
    base = stg.select(key, *tracked, effective.alias("valid_from"), order_col)
    lagged = base.select(
        "*", F.lag(F.lit(1)).over(w).alias("__pk"),
        *[F.lag(t).over(w).alias(f"__p_{t}") for t in tracked])
    vers = lagged.where(F.col("__pk").isNull() | any_differs(
        [(F.col(t), F.col(f"__p_{t}")) for t in tracked], null_safe))
    out = vers.select(key, *tracked, "valid_from", order_col,
                      F.lead("valid_from").over(w).alias("valid_to"),
                      F.lead(order_col).over(w).alias("closed_by"))
    out = out.withColumn("is_current", F.col("valid_to").isNull())
    cols = [key, *tracked, "valid_from", "valid_to", "is_current"]
    if keep_order_col:
        cols += [order_col, "closed_by"]
    return out.select(*cols)


def scd2_history(stg: DataFrame, key: str, tracked: Sequence[str], effective: Column,
                 null_safe: bool = False, order_col: str = "batch_key") -> DataFrame:
    """Type 2 versions of all batches in one pass, equal to the fold with any NULLs.

    Each key's rows (one per batch, so a short list) are collected, put in
    order and folded: a row opens a version when a tracked column differs
    from the last *accepted* row.  One shuffle, no window.
    Output: key, tracked..., valid_from, valid_to, is_current, ``opened_by``
    and ``closed_by`` (batches).
    """
    row = F.struct(F.col(order_col).alias("o"), effective.alias("f"),
                   *[F.col(t).alias(f"a{i}") for i, t in enumerate(tracked)])
    per_key = stg.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("rows"))

    def accept(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        differ = any_differs([(x[f"a{i}"], last[f"a{i}"]) for i in range(len(tracked))], null_safe)
        return F.when(differ, F.concat(acc, F.array(x))).otherwise(acc)

    kept = F.aggregate(F.slice("rows", 2, F.size("rows")), F.slice("rows", 1, 1), accept)
    folded = per_key.select(key, kept.alias("kept"))
    at = folded.select(key, F.posexplode("kept").alias("i", "v"), "kept")
    nxt = F.get("kept", F.col("i") + 1)
    return at.select(key, *[F.col(f"v.a{i}").alias(t) for i, t in enumerate(tracked)],
                     F.col("v.f").alias("valid_from"), nxt["f"].alias("valid_to"),
                     nxt.isNull().alias("is_current"),
                     F.col("v.o").alias("opened_by"), nxt["o"].alias("closed_by"))


def versions_as_of(history: DataFrame, bk: str) -> DataFrame:
    """The versions of a history with ``opened_by`` / ``closed_by`` as they stood
    after batch ``bk``: later ones are unknown, later closes undone."""
    closed = F.col("closed_by").isNotNull() & (F.col("closed_by") <= F.lit(bk))
    return (history.where(F.col("opened_by") <= F.lit(bk))
            .withColumns({"valid_to": F.when(closed, F.col("valid_to")), "is_current": ~closed,
                          "closed_by": F.when(closed, F.col("closed_by"))}))


def versions_after(history: DataFrame, bks: Sequence[str]) -> DataFrame:
    """``versions_as_of`` each of ``bks`` at once, with ``as_of``, the batch."""
    known = F.filter(F.array(*[F.lit(b) for b in bks]), lambda b: b >= F.col("opened_by"))
    closed = F.col("closed_by").isNotNull() & (F.col("closed_by") <= F.col("as_of"))
    return (history.withColumn("as_of", F.explode(known))
            .withColumns({"valid_to": F.when(closed, F.col("valid_to")), "is_current": ~closed,
                          "closed_by": F.when(closed, F.col("closed_by"))}))


def tracked_nulls(stg: DataFrame, tracked: Sequence[str]) -> Column:
    """An aggregate counting rows with a NULL tracked column (bulk guard)."""
    return F.count_if(reduce(or_, [F.col(t).isNull() for t in tracked]))
