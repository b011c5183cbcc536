"""Helpers shared by the operators: words, stored intermediates, components.

Intermediates that are read more than once (or cut lineage) are written as
Parquet under the cluster's shared folder, so a lost executor costs a re-read
and not a recomputation.  ``stored_result`` writes a result and then removes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson import paths
from keelson.session import shared_dir

#: A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Folders that ``store`` has written, in order, until they are removed.
STORED: list[str] = []


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    import uuid

    spark = df.sparkSession
    path = f"{shared_dir(spark)}/keelson/llm/{purpose}-{uuid.uuid4().hex[:12]}"
    STORED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_result(make, purpose: str) -> DataFrame:
    """``make()`` stored, and whatever it stored on its way removed once that is written."""
    before = len(STORED)
    out = store(make(), purpose)
    made = STORED[before:-1]
    del STORED[before:-1]
    for path in made:
        paths.delete(out.sparkSession, path)
    return out


def shielded(docs: DataFrame, used: list[str]):
    """``docs`` with every column but ``used`` under a neutral name, and a function that gives a
    frame of such rows the names and order of ``docs`` back.  So no name that an
    operator makes for itself can meet one of its input's."""
    own = {c: c if c in used else f"own{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*own.values()), lambda df: df.select(*[F.col(f"`{n}`").alias(c) for c, n in own.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over rows of equal ``keys`` (null-safe)
    whose ``order`` is smaller.  ``order`` is a whole number from 0, unique per ``keys``.

    Blocks of ``order`` are summed first, then run over, then each block within: no
    task sorts more than a block of rows or one row per block of a key.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    sums = blocked.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    line = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"), F.coalesce(F.sum("_sum").over(line), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = blocked.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("_block") == F.col("_b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return inner.join(ahead, same).select(*df.columns, (F.col("_ahead") + F.col("_inner")).alias(out))


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Smallest node reachable from each node of an undirected graph.

    ``edges`` has columns ``a`` and ``b`` of one orderable type, none null.
    Returns ``(node, root)`` for every node with an edge.

    Each round every node takes the least label of its neighbours, offers it to
    its old label's node (hooking) and then jumps to its label's label, so the
    number of rounds grows with the logarithm of a component's diameter.  The
    edge list itself is never rewritten: no node's degree grows, and the one
    join that can meet a heavy key (many nodes with the same label) reads both
    sides from stored tables, which adaptive execution may split.  It ends
    when no label changes, which one aggregate over a small table tells;
    running out of rounds raises.
    """
    sides = edges.select("a", "b").where("a <> b")
    links = store(sides.union(sides.select("b", "a")).distinct(), "cc-links")
    labels = store(links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "cc-labels")
    for _ in range(max_rounds):
        near = links.join(labels, links.a == labels.node).select(F.col("b").alias("node"), "root")
        own = labels.select("node", "root")
        # hooking: what a node's neighbour knows is offered to the node's old label as well
        offers = near.join(labels.select(F.col("node").alias("n"), F.col("root").alias("old")), F.col("node") == F.col("n"))
        hooks = offers.where("root < old").select(F.col("old").alias("node"), "root")
        hooked = store(near.union(own).union(hooks).groupBy("node").agg(F.min("root").alias("root")), "cc-hooked")
        up = hooked.select(F.col("node").alias("n"), F.col("root").alias("up"))
        nxt = store(hooked.join(up, hooked.root == up.n).select("node", F.col("up").alias("root")), "cc-labels")
        was = labels.select(F.col("node").alias("n"), F.col("root").alias("was"))
        moved = nxt.join(was, (F.col("node") == F.col("n")) & (F.col("root") != F.col("was")))
        labels = nxt
        if moved.isEmpty():
            return labels.select("node", "root")
    raise RuntimeError("components did not settle")
