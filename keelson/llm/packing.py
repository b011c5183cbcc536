"""Packing documents into sequences by mixture-controlled deficit round-robin.

Documents are tokenised once and stored.  Each source's documents are shuffled by a
hash and dealt in equal token shares to groups of about ``group_tokens``, so every
group holds the sources in nearly the same proportions (a source of few documents
begins at a group of its own hash); a group keeps one queue of tokens per source and fills
windows of ``window`` sequences: in turn every source's deficit grows by its
target proportion of a window, and it is served up to its deficit, so a window
holds the sources in the target proportions to within the pieces still owed.
What a source is owed (or has had too much) carries into the next window and,
as group sums of the sources tell it without running the groups one after
another, into the next group.

Target proportions are the sources' shares of all tokens by default (all
documents are packed, so no other mix can hold to the end); others may be given.
Sequences hold exactly ``length`` tokens.  What is left at the end of a group
is cut into sequences whose lengths are powers of two, so no token is padding.

Scale: token ids are stored and shuffled once, 2 bytes an id; a group's memory is
bounded by ``group_tokens`` and its longest document, whatever the hot source.  Rows
that repeat in id, source and text share a hash; where their tokens exceed a bucket's
share they are dealt by their place in the stored tokens as well.

Defined results: a null or empty text is the end token alone; a null source is a
source of its own; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from heapq import heapify, heappop, heapreplace
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import running_sum, store
from keelson.llm.tokenise import encode_batches

PIECES = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Packing:
    length: int = 1024
    #: sequences to a window: the span over which proportions are kept
    window: int = 8
    #: a source waits until it is owed so many tokens (or its document's rest)
    least: int = 64
    group_tokens: int = 1 << 21
    #: hash buckets to a group, the grain in which a source is dealt to groups
    buckets: int = 32
    #: most rows of the (source, bucket) table that are broadcast (about 40 bytes each)
    broadcast_rows: int = 1 << 18
    end: int = 0


def tokens(docs: DataFrame, ranks: bytes, end: int = 0) -> DataFrame:
    """``(doc_id, source, h, n, ids)``; ``ids`` are little-endian 16-bit ids."""
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("doc_id", "source", "text").alias("h"),
        F.col("text").cast("string").alias("text"),
    )
    return slim.mapInArrow(encode_batches(ranks, "<u2", end), "doc_id long, source string, h long, n long, ids binary")


def round_robin(queues: list[list[int]], share: list[float], owed: list[float], window: int, least: int):
    """Yield ``(document, start, length)`` runs in the order of packing.

    ``queues`` has the token counts of each source's documents; ``share`` the target
    proportions and ``owed`` the deficits carried in.  Documents are numbered
    within their source: the run names ``(source, index)``.
    """
    at = [[0, 0] for _ in queues]  # next document, tokens of it already served
    floor = 1e-9
    grow = [max(x, floor) * window for x in share]  # a round's growth of the deficit

    def rounds(s: int) -> int:
        """Rounds until the source can be served."""
        return max(1, ceil((min(least, queues[s][at[s][0]] - at[s][1]) - owed[s]) / grow[s]))

    # only sources that are due are looked at, in their order within a round
    due, last = [(rounds(s), s) for s, q in enumerate(queues) if q], [0] * len(queues)
    heapify(due)
    while due:
        r, s = due[0]
        owed[s] += (r - last[s]) * grow[s]
        last[s] = r
        q, pos = queues[s], at[s]
        while pos[0] < len(q):
            rest = q[pos[0]] - pos[1]
            take = min(int(owed[s]), rest)
            if take <= 0 or (take < rest and take < least):
                break
            yield (s, pos[0]), pos[1], take
            owed[s] -= take
            pos[1] += take
            if pos[1] == q[pos[0]]:
                pos[0], pos[1] = pos[0] + 1, 0
        if pos[0] == len(q):
            heappop(due)
        else:
            heapreplace(due, (r + rounds(s), s))


def pack_group(p: Packing):
    """A cogroup function: a group's documents and its sources' shares and deficits."""

    def run(docs: pa.Table, state: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string())] + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
        if not docs.num_rows:
            return schema.empty_table()
        docs = docs.sort_by([("h", "ascending"), ("doc_id", "ascending")])
        known = {r["source"]: r for r in state.to_pylist()}
        names = sorted(known, key=lambda s: (s is None, s))
        rows: dict = {s: [] for s in names}
        for i, s in enumerate(docs.column("source").to_pylist()):
            rows[s].append(i)
        counts, ids, doc_ids = docs.column("n").to_pylist(), docs.column("ids"), docs.column("doc_id").to_pylist()
        group = docs.column("group")[0].as_py()
        queues = [[counts[i] for i in rows[s]] for s in names]
        runs = round_robin(queues, [known[s]["share"] for s in names], [known[s]["owed"] for s in names], p.length * p.window, p.least)
        total = sum(counts)
        whole, rest = divmod(total, p.length)
        # lengths of the sequences: full ones, then the powers of two of the rest
        short = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        out: list[tuple] = []
        seq, room, used, cache = 0, (p.length if whole else short[0]), 0, {}
        for (s, k), start, n in runs:
            i = rows[names[s]][k]
            if i not in cache:
                cache[i] = np.frombuffer(ids[i].as_py(), "<u2").astype("<u4")
            have = cache[i]
            while n:
                take = min(n, room - used)
                out.append((doc_ids[i], names[s], start, take, zlib.crc32(have[start : start + take].tobytes()), counts[i], (group << 32) | seq, used))
                start, n, used = start + take, n - take, used + take
                if used == room:
                    seq, used = seq + 1, 0
                    room = p.length if seq < whole else (short[seq - whole] if seq - whole < len(short) else 0)
            if start == counts[i]:
                del cache[i]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def spread(made: DataFrame, p: Packing) -> DataFrame:
    """``made`` with ``salt``: the place of a row whose repeats fill more than a bucket's
    tokens, else one number.  Such contents are fewer than buckets of the corpus."""
    repeats = made.groupBy("source", "h").agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("c"))
    hot = repeats.where((F.col("c") > 1) & (F.col("m") > p.group_tokens / p.buckets))
    hot = store(hot.select(F.col("source").alias("s"), F.col("h").alias("g")), "token-repeats")
    n = hot.count()
    if not n:
        return made.withColumn("salt", F.lit(7).cast("long"))
    if n <= p.broadcast_rows:
        hot = F.broadcast(hot)
    met = made.join(hot, F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("g")), "left")
    return met.withColumn("salt", F.when(F.col("g").isNotNull(), F.col("place")).otherwise(7)).drop("s", "g")


def pack(docs: DataFrame, ranks: bytes, packing: Packing | None = None, weights: dict[str | None, float] | None = None) -> DataFrame:
    """Pieces of all documents: see ``PIECES``.  ``ranks`` is the vocabulary file.

    ``weights`` (target proportions by source, default the sources' token shares)
    need not sum to one; a source that is not named counts as 0 and is packed last.
    """
    p = packing or Packing()
    made = store(tokens(docs, ranks, p.end).withColumn("place", F.monotonically_increasing_id()), "tokens")
    total = made.agg(F.sum("n")).first()[0] or 0
    groups = max(1, round(total / p.group_tokens))
    buckets = p.buckets * groups
    made = spread(made, p).withColumn("bucket", F.pmod(F.xxhash64("h", "salt"), F.lit(buckets)))
    cells = store(made.groupBy("source", "bucket").agg(F.sum("n").alias("n")), "token-cells")
    by_source = cells.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("all"))
    # a bucket goes where the middle of its tokens lies on its source's line; the lines are
    # turned by a hash each, or the middles of all sources of one document would meet
    lined = running_sum(cells, ["source"], "bucket", "n", "before").join(by_source, F.col("source").eqNullSafe(F.col("s")))
    turn = F.pmod(F.xxhash64("source"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    middle = ((F.col("before") + F.col("n") / 2) / F.col("all") + turn) % F.lit(1.0)
    dealt = lined.select("source", "bucket", "n", F.least(F.floor(middle * groups), F.lit(groups - 1)).cast("long").alias("group"))
    dealt = store(dealt, "token-groups")
    table = dealt.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.col("group").alias("to"))
    if dealt.count() <= p.broadcast_rows:
        table = F.broadcast(table)
    made = made.join(table, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select("doc_id", "source", "h", "n", "ids", F.col("to").alias("group"))
    sums = store(dealt.groupBy("group", "source").agg(F.sum("n").alias("n")), "token-sums")
    if weights is None:
        by_source = by_source.select("s", (F.col("all") / F.lit(float(max(total, 1)))).alias("share"))
    else:
        whole = sum(weights.values())
        named = F.lit(0.0)
        for k, w in weights.items():
            named = F.when(F.col("s").eqNullSafe(F.lit(k)), F.lit(w / whole)).otherwise(named)
        by_source = by_source.select("s", named.alias("share"))
    totals = sums.groupBy(F.col("group").alias("g")).agg(F.sum("n").alias("m"))
    ahead = running_sum(totals, [], "g", "m", "ahead").select("g", "ahead")
    had = running_sum(sums, ["source"], "group", "n", "had")
    state = had.join(by_source, F.col("source").eqNullSafe(F.col("s"))).join(ahead, F.col("group") == F.col("g"))
    state = state.select("group", "source", "share", (F.col("share") * F.col("ahead") - F.col("had")).alias("owed"))
    return made.groupBy("group").cogroup(state.groupBy("group")).applyInArrow(pack_group(p), PIECES)
