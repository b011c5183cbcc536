"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled (ordered by a hash) and laid end to end;
the line of a source is cut into blocks of equal size.  A schedule of slots picks
sources: slot i falls at the golden-ratio point ``frac(i * 0.618...)``, and the
source whose stretch of cumulative weight holds the point takes the slot.  The
k-th slot of a source is joined with its block ``k mod blocks`` (epoch
``k div blocks``), so any run of slots holds the sources near their weights and a
source that is wanted more than once repeats only after a full pass.

The points hit a source's wanted number of slots up to a few; surplus slots are
dropped, missing ones follow at the end, and a source's last slot takes just the
part of its block that the target still needs.  So every source's words come
to its target, rounded down to a word.

Scale: nothing is collected, and sources themselves may be many.  Running sums (a document's place on its
source's line, a slot's rank in its source) go over buckets of a hash, the
buckets' own sums over blocks of buckets, and then within a bucket, so a source with a
third of all rows is spread over as many buckets as any part of the input of that
size.  The schedule's points are found by range arithmetic per source, not by a
scan of all slots against all sources.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own, ordered last; an empty table gives no rows; rows that agree
in id, source and text share what they took one after the other: whole passes over all
of them are each row's, of the rest the first rows take their whole text, one takes
a part and the others nothing; sources without words have target 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import running_sum, shielded, store, words

#: Fixed value: the golden ratio less one.
GOLDEN = 0.6180339887498949


@dataclass(frozen=True)
class Mix:
    """Weights in source order, share of all words to take, largest repeat."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: float = 2.0
    block: int = 1024
    rows_per_bucket: int = 4096
    chunk: int = 4096


def row_hash(key: str, source: str, text: str) -> Column:
    """60 bits of a row's content: the order of the shuffle, the same in any engine."""
    content = F.concat_ws("\x1f", F.col(key), F.col(source), F.col(text))
    return F.conv(F.substring(F.md5(content), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``(doc_id, source, size, h)`` of every row; ``h`` shuffles and identifies."""
    t = F.col(text)
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.size(words(t)).cast("long").alias("size"),
        row_hash(key, source, text).alias("h"),
    )


def numbered_in(rows: DataFrame, order: list[Column], purpose: str) -> DataFrame:
    """``rows`` with ``rank``, their number from 0 in ``order``: a range-partitioned sort, the
    partitions' own counts run over (a row each), then numbers within each."""
    ordered = store(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), purpose)
    parts = ordered.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = parts.select(F.col("part").alias("p"), before.alias("ahead"))
    rank = F.col("ahead") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ordered.join(ahead, F.col("part") == F.col("p")).select(*rows.columns, rank.cast("long").alias("rank"))


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``sources (source, source_size)`` with ``rank``, ``weight`` and ``target``.

    Targets are ``min(most * size, level * weight)`` at the level at which they sum to the
    wanted share.  Put in the order of cap over weight, the sources capped at any level
    come first, so each place of that order gives a level (the wanted share less the caps
    before it, over the weights from it on), and the greatest is the one: one more sort
    and two running sums over blocks, whatever the number of sources.
    """
    cycle = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = numbered_in(sources, [F.col("source").asc_nulls_last()], "mix-sources")
    weighed = ranked.withColumn("weight", F.get(cycle, (F.col("rank") % len(mix.weights)).cast("int")))
    weighed = store(weighed.withColumn("cap", mix.most * F.col("source_size")), "mix-weights")
    all_of = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    wanted, weights = mix.share * (all_of["size"] or 0), all_of["weight"] or 0.0
    steps = numbered_in(weighed.select("cap", "weight", (F.col("cap") / F.col("weight")).alias("ratio")), [F.col("ratio").asc()], "mix-ratios")
    steps = running_sum(store(steps, "mix-steps"), [], "rank", "cap", "fixed")
    steps = running_sum(store(steps, "mix-fixed"), [], "rank", "weight", "passed")
    level = steps.agg(F.max((F.lit(wanted) - F.col("fixed")) / (F.lit(weights) - F.col("passed")))).first()[0]
    return weighed.withColumn("target", F.least("cap", F.lit(level if level is not None else 0.0) * F.col("weight")))


def places(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with ``start``: words before the row on its source's line."""
    bucketed = rows.withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("words").alias("total"))
    offsets = running_sum(store(sums, "mix-buckets"), ["source"], "bucket", "total", "offset").select(F.col("source").alias("s"), F.col("bucket").alias("b"), "offset")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    run = bucketed.withColumn("inner", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    joined = run.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.select("doc_id", "source", "h", "size", "copies", "words", (F.col("offset") + F.col("inner")).alias("start"))


def schedule(plan: DataFrame, mix: Mix) -> DataFrame:
    """``(source, k, slot)``: the k-th slot (from 0) of each source.

    ``plan`` has ``source, rank, wanted`` (slots).  A chunk of consecutive slots
    belongs to one row of a generated range, and each of its points looks its
    source up in the cumulative stretches by a sort-free band: points and
    stretches are cut into the same cells of the unit interval, and only those of
    one cell meet.
    """
    spark = plan.sparkSession
    n_slots = plan.agg(F.sum("wanted")).first()[0] or 0
    whole = F.lit(float(max(n_slots, 1)))
    stretch = running_sum(plan.select("source", "rank", "wanted"), [], "rank", "wanted", "before").where("wanted > 0")
    stretch = stretch.withColumn("low", F.col("before") / whole).withColumn("high", F.col("low") + F.col("wanted") / whole)
    cells = 1 << max(10, plan.count().bit_length())  # so that few stretches share a cell
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1)).cast("long")
    bands = stretch.select("source", "wanted", "low", "high", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("c"))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), F.pmod(F.col("id") * F.lit(GOLDEN), F.lit(1.0)).alias("u"))
    points = points.withColumn("cell", cell(F.col("u")))
    # the last stretch is open above, so that rounding never leaves a point alone
    inside = (F.col("u") >= F.col("low")) & ((F.col("u") < F.col("high")) | (F.col("high") >= 1.0 - 1e-12))
    picked = points.join(bands, (F.col("cell") == F.col("c")) & inside).select("source", "wanted", "slot", F.floor(F.col("slot") / mix.chunk).alias("chunk"))
    picked = store(picked, "mix-slots")
    sums = picked.groupBy("source", "chunk").count()
    offsets = running_sum(store(sums, "mix-chunks"), ["source"], "chunk", "count", "offset").select(F.col("source").alias("s"), F.col("chunk").alias("b"), "offset")
    inner = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    ranked = picked.withColumn("inner", inner).join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("b")))
    ranked = ranked.withColumn("k", F.col("offset") + F.col("inner")).where("k < wanted").select("source", "k", "slot")
    had = picked.groupBy(F.col("source").alias("s")).count()
    short = plan.join(had, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "wanted", F.coalesce("count", F.lit(0)).alias("n")).where("n < wanted")
    late = short.select("source", F.explode(F.sequence(F.col("n").cast("long"), F.col("wanted").cast("long") - 1)).alias("k"), F.lit(n_slots).cast("long").alias("slot"))
    return ranked.union(late)


def mix_sources(docs: DataFrame, mix: Mix | None = None, key: str = "doc_id", source: str = "source", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The mix of all rows: ``(taken, blocks)``.

    ``taken`` has per distinct row ``doc_id, source, h, size, copies, source_size,
    target, taken`` (``taken`` for all ``copies`` of the row together).  ``blocks`` is
    the order of the mix: ``slot, source, epoch, block, doc_id, h, first, words``, one
    row per stretch of a document in a slot.
    """
    mix = mix or Mix()
    rows = store(sized(docs, key, source, text), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sources, mix)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / mix.block)).cast("long")
    plan = plan.withColumns({"blocks": blocks, "goal": F.floor("target").cast("long")})
    # block j of a source covers words [j * size / blocks, (j + 1) * size / blocks)
    full, rest = F.floor(F.col("goal") / F.greatest(F.col("source_size"), F.lit(1))), F.col("goal") % F.greatest(F.col("source_size"), F.lit(1))
    partial = F.ceil(rest * F.col("blocks") / F.greatest(F.col("source_size"), F.lit(1)))
    plan = store(plan.withColumn("wanted", F.when(F.col("goal") > 0, full * F.col("blocks") + partial).otherwise(0).cast("long")), "mix-plan")

    distinct = rows.groupBy("doc_id", "source", "h").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("copies"))
    distinct = distinct.withColumn("words", F.col("size") * F.col("copies"))
    n_rows = rows.count()
    lined = store(places(distinct, max(1, n_rows // mix.rows_per_bucket)), "mix-places")

    edge = lambda j: F.floor(j * F.col("source_size") / F.col("blocks")).cast("long")
    block_of = lambda x: F.floor(((x + 1) * F.col("blocks") - 1) / F.col("source_size")).cast("long")
    facts = plan.select(F.col("source").alias("s"), "source_size", "target", "blocks", "goal")
    whole = lined.where("words > 0").join(facts, F.col("source").eqNullSafe(F.col("s")))
    cut = whole.select("*", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("start") + F.col("words") - 1))).alias("block"))
    low, high = F.greatest(F.col("start"), edge(F.col("block"))), F.least(F.col("start") + F.col("words"), edge(F.col("block") + 1))
    pieces = cut.select("doc_id", "source", "h", "start", "source_size", "goal", "blocks", "block", low.alias("low"), high.alias("high")).where("high > low")
    slots = schedule(plan.select("source", "rank", "wanted"), mix)
    slots = slots.join(facts.select("s", F.col("blocks").alias("n")), F.col("source").eqNullSafe(F.col("s")))
    slots = slots.select(F.col("source").alias("src"), F.col("slot"), (F.col("k") % F.col("n")).alias("j"), F.floor(F.col("k") / F.col("n")).alias("epoch"))
    met = slots.join(pieces, F.col("src").eqNullSafe(F.col("source")) & (F.col("j") == F.col("block")))
    # the last slot of a source stops at its goal
    stop = F.col("goal") - F.col("epoch") * F.col("source_size")
    end = F.least(F.col("high"), stop)
    order = met.where(end > F.col("low")).select("slot", "source", "epoch", "block", "doc_id", "h", (F.col("low") - F.col("start")).alias("first"), (end - F.col("low")).alias("words"))
    order = store(order, "mix-order")

    took = order.groupBy(F.col("source").alias("s"), F.col("h").alias("g"), F.col("doc_id").alias("d")).agg(F.sum("words").alias("taken"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d"))
    per_row = lined.join(took, same, "left").select("doc_id", "source", "h", "size", "copies", F.coalesce("taken", F.lit(0)).alias("taken"))
    known = per_row.join(facts.select("s", "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
    return known.select("doc_id", "source", "h", "size", "copies", "source_size", "target", "taken"), order


def shares(taken: DataFrame) -> DataFrame:
    """What each of a row's copies took: a row for those that took alike, ``copies`` of them."""
    passes, rest = passed(F.col("taken"), F.col("size"), F.col("copies"))
    each = taken.withColumns({"_base": passes * F.col("size"), "_rest": rest}).withColumn("_full", F.floor(F.col("_rest") / F.greatest(F.col("size"), F.lit(1))))
    part = F.col("_rest") - F.col("_full") * F.col("size")
    cut = F.when(part > 0, 1).otherwise(0)
    alike = [(F.col("_full"), F.col("_base") + F.col("size")), (cut, F.col("_base") + part), (F.col("copies") - F.col("_full") - cut, F.col("_base"))]
    each = each.withColumn("_alike", F.explode(F.array(*[F.struct(n.cast("long").alias("n"), t.cast("long").alias("t")) for n, t in alike]))).where("_alike.n > 0")
    return each.select("doc_id", "source", "h", "size", F.col("_alike.n").alias("copies"), "source_size", "target", F.col("_alike.t").alias("taken"))


def passed(taken: Column, size: Column, copies: Column) -> tuple[Column, Column]:
    """Whole passes over all copies of a row in ``taken`` words, and the words left."""
    all_words = F.greatest(size * copies, F.lit(1))
    return F.floor(taken / all_words).cast("long"), taken % all_words


def numbered(rows: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """``rows`` with ``_n``, their number from 0 among rows of equal ``keys`` (null-safe).

    Rows are stored in chunks of places first, so a heavily repeated row is numbered by many tasks.
    """
    placed = store(rows.withColumn("_place", F.monotonically_increasing_id()), "mix-copies").withColumn("_chunk", F.floor(F.col("_place") / chunk))
    sums = store(placed.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows")), "mix-copy-counts")
    ahead = running_sum(sums, keys, "_chunk", "_rows", "_before").select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("_chunk").alias("_chunk_"), "_before")
    same = F.col("_chunk") == F.col("_chunk_")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy("_place")) - 1
    return placed.withColumn("_inside", inside).join(ahead, same).select(*rows.columns, (F.col("_before") + F.col("_inside")).alias("_n"))


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word."""
    return F.array_join(F.slice(words(text), F.lit(1), n.cast("int")), " ")


def apply_mix(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """``docs`` as mixed: a row taken once and a half stands there twice, the second
    time cut after half of its words; a row not taken is absent.  Columns are
    those of ``docs``; ``n_chars``, where there is one, follows a cut text."""
    mix = mix or Mix()
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    inside, back = shielded(docs, ["doc_id", "source", "text", "n_chars"])
    taken, _ = mix_sources(inside, mix)
    known = taken.where("size > 0 and taken > 0").select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("h").alias("_h"), F.col("size").alias("_size"), F.col("copies").alias("_copies"), F.col("taken").alias("_taken"))
    known = store(known, "mix-taken")
    keyed = inside.withColumn("_k", row_hash("doc_id", "source", "text"))
    same = (F.col("_k") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s"))
    met = keyed.join(known, same)
    if not known.where("_copies > 1").isEmpty():
        many = numbered(met.where("_copies > 1"), ["_h", "_d", "_s"], mix.chunk)
        passes, rest = passed(F.col("_taken"), F.col("_size"), F.col("_copies"))
        own = passes * F.col("_size") + F.least(F.greatest(rest - F.col("_n") * F.col("_size"), F.lit(0)), F.col("_size"))
        many = many.withColumn("_taken", own).where("_taken > 0").drop("_n")
        met = met.where("_copies = 1").unionByName(many)
    epochs = F.ceil(F.col("_taken") / F.col("_size")).cast("int")
    rows = met.withColumn("_e", F.explode(F.sequence(F.lit(1), epochs)))
    left = F.col("_taken") - (F.col("_e") - 1) * F.col("_size")
    cut = left < F.col("_size")
    out = rows.withColumn("text", F.when(cut, first_words(F.col("text"), left)).otherwise(F.col("text")))
    if kind is not None:
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return back(out)
