"""Conversation structure repair by Knuth's lightest-derivation agenda.

The repaired roles' initials must read ``(s?(ua)+)?``.  Its automaton has the states
0 (nothing yet), 1 (after system), 2 (after user) and 3 (after assistant); 0 and 3
accept.  An item ``[i, q]`` says that the first i rows are repaired and the automaton
is in q; deductions are the edits, each with a cost and an initial:

    K keep 0 | R rerole to the role the state expects 1 | D delete 2 | I insert an empty turn 5

(a kept or reroled truncated row costs 5 more; blank and duplicate rows can only be
deleted).  A weight is (cost, audit), the audit being the initials in order.  Adding
an edit never makes a weight lighter, so Knuth's generalisation of Dijkstra's method
applies: the agenda pops the lightest item, which is final, and deduces from it.

A conversation is not one unit of work.  Rows are range-partitioned by conversation
and turn, so a heavy conversation spreads over many tasks; of a stretch of rows a task
derives the items ``[p, q]`` (from state p before to state q after it) in blocks of
``BLOCK`` rows, and two neighbouring stretches join by the two-antecedent deduction
``[p, q], [q, r] -> [p, r]`` (costs add, audits concatenate), run by the same agenda.
Audits of one item with equal costs hold equally many inserts, so none is a prefix of
another and the least of all concatenations is the concatenation of the least ones.
Conversations that lie within one task are finished there; the others' stretches meet
by conversation, small, and their rows stream once through the hash of the result.

Rows that are equal in all four columns are counted before the first shuffle, and a
text's earlier turn is found by an aggregate over digests, so copies are no hot spot.

Defined results: a null role or text is one blank; a null conversation id is a
conversation of its own; rows follow by turn (null first), then role, then text; a
role's initial is its first character, in its own case (no role: no legal place);
``gaps`` ends at 2**63 - 1; a conversation without rows (``copies`` 0) has zeros, an
empty audit and the empty text's hash; other columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import store
from keelson.operators.sizing import fits_broadcast

#: The six white-space characters, ends of a sentence, legal neighbours.
BLANKS, ENDS, LEGAL = " \t\n\v\f\r", ".!?", ("su", "ua", "au")
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}  # initial -> state -> next state
EXPECTED = {0: "user", 1: "user", 2: "assistant", 3: "user"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK, HOLD = 256, 32 << 20
TOP = 2**63 - 1

Weight = tuple[int, str]
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def knuth(axioms: Iterable[tuple[Weight, tuple]], deduce: Callable, goal: Callable = lambda item: False) -> dict[tuple, Weight]:
    """Lightest weight of every item, in the order of weights, up to the first ``goal``.

    ``deduce(item, weight, final)`` gives the (weight, item) pairs that follow from an
    item just made final, alone or with other final items.
    """
    agenda, final = [(*w, item) for w, item in axioms], {}
    heapq.heapify(agenda)
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        if goal(item):
            break
        for w, to in deduce(item, (cost, audit), final):
            if to not in final:
                heapq.heappush(agenda, (*w, to))
    return final


def row_items(rows: list[tuple], entries: Iterable[int]) -> dict[tuple, Weight]:
    """``{(p, q): weight}`` of a stretch of (initial, must go, truncated) rows."""
    out = {}

    def deduce(item, weight, _):
        (i, q), (cost, audit) = item, weight
        to = AFTER[EXPECTED[q][0]][q]
        yield (cost + INSERT, audit + "I"), (i, to)
        if i < len(rows):
            initial, gone, cut = rows[i]
            yield (cost + DELETE, audit + "D"), (i + 1, q)
            if not gone:
                more = cost + TRUNCATED * cut
                kept = AFTER.get(initial, {}).get(q)
                if kept is not None:
                    yield (more, audit + "K"), (i + 1, kept)
                if kept != to:
                    yield (more + REROLE, audit + "R"), (i + 1, to)

    for p in entries:
        final = knuth([((0, ""), (0, p))], deduce)
        out |= {(p, q): final[len(rows), q] for q in range(4) if (len(rows), q) in final}
    return out


def joined(left: dict[tuple, Weight], right: dict[tuple, Weight]) -> dict[tuple, Weight]:
    """Items of two neighbouring stretches taken together."""
    axioms = [(w, ("left", *pq)) for pq, w in left.items()] + [(w, ("right", *pq)) for pq, w in right.items()]

    def deduce(item, weight, final):
        side, p, q = item
        if side == "left":
            mates = (((p, r), weight, final["right", q, r]) for r in range(4) if ("right", q, r) in final)
        elif side == "right":
            mates = (((o, q), final["left", o, p], weight) for o in range(4) if ("left", o, p) in final)
        else:
            return
        for ends, (c1, a1), (c2, a2) in mates:
            yield (c1 + c2, a1 + a2), ("both", *ends)

    return {(p, q): w for (side, p, q), w in knuth(axioms, deduce).items() if side == "both"}


class Stretch:
    """Counts and items of a run of neighbouring rows of one conversation."""

    def __init__(self, entries: Iterable[int] = (0,)) -> None:
        self.entries = list(entries)
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = None  # turns
        self.first = self.last = None  # initials
        self.items = {(p, p): (0, "") for p in self.entries}
        self.rows: list[tuple] = []

    def add(self, turn: int | None, role: str, text: str, n: int, late: bool) -> None:
        """``n`` equal rows; ``late``: an earlier turn holds the same role and text."""
        if not n:
            return
        if turn is not None and turn != self.high:
            self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial, end = role[:1], text.rstrip(BLANKS)[-1:]
        self.illegal += n - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.first, self.last = initial if self.first is None else self.first, initial
        copies = n if not end else n - 1 + late
        if not end:
            self.blank += n
        else:
            self.duplicate += copies
            self.truncated += (not late) and end not in ENDS
        if end and not late:
            self.rows.append((initial, False, end not in ENDS))
        for _ in range(copies):
            self.rows.append((initial, True, False))
            self.settle(BLOCK)
        self.settle(BLOCK)

    def settle(self, at_least: int = 1) -> None:
        """Derive the rows not yet covered by ``items``."""
        if len(self.rows) >= at_least:
            fresh = not any(audit for _, audit in self.items.values())
            made = row_items(self.rows, self.entries if fresh else range(4))
            self.items = made if fresh else joined(self.items, made)
            self.rows = []

    def follow(self, other: Stretch) -> None:
        """Append the stretch that comes next in the conversation."""
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        if self.last is not None and other.first is not None:
            self.illegal += self.last + other.first not in LEGAL
        self.distinct += other.distinct - (other.low is not None and other.low == self.high)
        self.low, self.high = other.low if self.low is None else self.low, self.high if other.high is None else other.high
        self.first, self.last = other.first if self.first is None else self.first, self.last if other.last is None else other.last
        self.items = joined(self.items, other.items)

    def dump(self) -> str:
        self.settle()
        values = {k: v for k, v in vars(self).items() if k not in ("rows", "items", "entries")}
        return json.dumps(values | {"items": [[*pq, *w] for pq, w in self.items.items()]})

    @staticmethod
    def load(text: str, entries: Iterable[int] = range(4)) -> Stretch:
        values, out = json.loads(text), Stretch(entries)
        items = values.pop("items")
        vars(out).update(values)
        out.items = {(p, q): (cost, audit) for p, q, cost, audit in items if p in out.entries}
        return out

    def report(self) -> dict:
        """Counts, cost and audit of the whole conversation."""
        self.settle()
        goals = [((0, ""), ("start",))]

        def deduce(item, weight, _):
            if item == ("start",):
                yield from ((w, pq) for pq, w in self.items.items() if pq[0] == 0)
            elif item[1] in (0, 3):
                yield weight, ("goal",)

        cost, audit = knuth(goals, deduce, lambda item: item == ("goal",))["goal",]
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.distinct, TOP)
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit}


class Repaired:
    """Applies an audit to a conversation's rows as they stream by."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield self.turn("I", EXPECTED[self.state], "")

    def turn(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        self.at += 1
        self.state = AFTER[role[0]][self.state]
        return edit, role, text

    def row(self, role: str, text: str, n: int) -> Iterator[tuple[str, str, str]]:
        for _ in range(n):
            yield from self.inserts()
            edit = self.audit[self.at]
            if edit == "D":
                self.at += 1
            else:
                yield self.turn(edit, EXPECTED[self.state] if edit == "R" else role, text)


class Digest:
    """SHA-256 over ``role:text`` lines."""

    def __init__(self) -> None:
        self.sha, self.gap = hashlib.sha256(), b""

    def add(self, turns: Iterable[tuple[str, str, str]]) -> None:
        for _, role, text in turns:
            self.sha.update(self.gap + f"{role}:{text}".encode())
            self.gap = b"\n"


KINDS = {"conv_id": pa.int64(), "part": pa.int32(), "place": pa.int64(), "kind": pa.string(), "role": pa.string(), "text": pa.string(), "n": pa.int64(), "piece": pa.string(), **dict.fromkeys(REPORT, pa.int64()), "audit": pa.string(), "repaired_sha256": pa.string()}
EVENT = ", ".join(f"{k} {'int' if v == pa.int32() else 'long' if v == pa.int64() else 'string'}" for k, v in KINDS.items())


def batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in KINDS.items()], list(KINDS))


def in_batches(events: Iterator[dict], rows: int = 4096, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for e in events:
        held.append(e)
        n += len(e.get("text") or "") + len(e.get("audit") or "") + len(e.get("piece") or "")
        if len(held) >= rows or n >= size:
            yield batch(held)
            held, n = [], 0
    yield batch(held)


def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for k in range(0, b.num_rows, 1024):
            part = b.slice(k, 1024)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def runs(batches: Iterator[pa.RecordBatch], part: int, hold: int) -> Iterator[dict]:
    """Events of one sorted partition: a report for every conversation that surely begins
    and ends in it, else a piece and (as they stream) its rows."""
    conv, now, held, size, place, first = None, None, [], 0, 0, True

    def line(role, text, n):
        nonlocal place
        place += 1
        return {"conv_id": conv, "part": part, "place": place, "kind": "row", "role": role, "text": text, "n": n}

    def closed(edge: bool) -> Iterator[dict]:
        nonlocal place
        if edge or size > hold:
            yield from (line(*r) for r in held)
            place += 1
            yield {"conv_id": conv, "part": part, "place": place, "kind": "piece", "piece": now.dump()}
            return
        report, digest = now.report(), Digest()
        plan = Repaired(report["audit"])
        for r in held:
            digest.add(plan.row(*r))
        digest.add(plan.inserts())
        yield {"conv_id": conv, "kind": "report", **report, "repaired_sha256": digest.sha.hexdigest()}

    for c, turn, role, text, n, late in lines(batches):
        if now is None or c != conv:
            if now is not None:
                yield from closed(first)
                first = False
            conv, now, held, size = c, Stretch(range(4) if now is None else (0,)), [], 0
        now.add(turn, role, text, n, late)
        if n:
            size += len(text) + len(role) + 64
            held.append((role, text, n))
            if size > hold:  # rows go on at once, to be hashed when the audit is known
                yield from (line(*r) for r in held)
                held = []
    if now is not None:
        yield from closed(True)


def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """A report (no digest yet) for every conversation from its pieces in order."""
    conv, whole = None, None
    for c, piece in lines(batches):
        if whole is not None and c == conv:
            whole.follow(Stretch.load(piece))
            continue
        if whole is not None:
            yield {"conv_id": conv, "part": -1, "place": -1, "kind": "report", **whole.report()}
        conv, whole = c, Stretch.load(piece, (0,))
    if whole is not None:
        yield {"conv_id": conv, "part": -1, "place": -1, "kind": "report", **whole.report()}


def concluded(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Reports with their digests, from each report followed by its rows."""
    report = plan = digest = None

    def done():
        digest.add(plan.inserts())
        return report | {"repaired_sha256": digest.sha.hexdigest()}

    for values in lines(batches):
        e = dict(zip(KINDS, values, strict=True))
        if e["kind"] == "report":
            if report is not None:
                yield done()
            report, plan, digest = e, Repaired(e["audit"]), Digest()
        else:
            digest.add(plan.row(e["role"], e["text"], e["n"]))
    if report is not None:
        yield done()


def counted(chats: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, n, digest)``: distinct rows and how often they stand.

    An optional column ``copies`` says how often a row counts (0: only its conversation).
    """
    n = F.col("copies").cast("long") if "copies" in chats.columns else F.lit(1)
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = chats.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), filled("role"), filled("text"), n.alias("n"))
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    return equal.withColumn("digest", F.unhex(F.sha2("text", 256)))


def marked(rows: DataFrame) -> DataFrame:
    """Counted rows with ``late``: an earlier turn has the same role and text."""
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    again = rows.where("n > 0").groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    again = store(again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("first"), F.lit(True).alias("again")), "repair-again")
    if fits_broadcast(again):
        again = F.broadcast(again)
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    late = F.coalesce("again", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    return rows.join(again, same, "left").select("conv_id", "turn", "role", "text", "n", late.alias("late"))


def repair_conversations(chats: DataFrame, hold: int = HOLD) -> DataFrame:
    """A row per conversation of ``chats (conv_id, turn, role, text)``: ``conv_id``, ``gaps``,
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and
    ``repaired_sha256`` (of the repaired ``role:text`` lines)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from in_batches(runs(batches, TaskContext.get().partitionId(), hold))

    rows = store(counted(chats), "repair-rows")
    # a text's beginning takes part in the ranges, for many rows of one turn
    dealt = marked(rows).repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    events = store(dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(each, EVENT), "repair-events")
    pieces = events.where("kind = 'piece'").select("conv_id", "part", "place", "piece").repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    headers = pieces.select("conv_id", "piece").mapInArrow(lambda b: in_batches(stitched(b)), EVENT)
    streams = headers.unionByName(events.where("kind = 'row'")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    late = streams.mapInArrow(lambda b: in_batches(concluded(b)), EVENT)
    return events.where("kind = 'report'").unionByName(late).select("conv_id", *REPORT, "audit", "repaired_sha256")


def repaired_turns(chats: DataFrame, reports: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, role, text)``: the turns that ``reports``' audits make of ``chats``.

    A conversation's rows stream behind its audit; a task holds one audit and a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            conv, plan, place = None, None, 0
            for c, role, text, n, audit in lines(batches):
                if audit is not None:
                    if plan is not None:
                        yield from ((conv, place + k, *t) for k, t in enumerate(plan.inserts()))
                    conv, plan, place = c, Repaired(audit), 0
                    continue
                for t in plan.row(role, text, n):
                    yield (conv, place, *t)
                    place += 1
            if plan is not None:
                yield from ((conv, place + k, *t) for k, t in enumerate(plan.inserts()))

        names, kinds = ["conv_id", "place", "edit", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        held: list[tuple] = []
        for t in made():
            held.append(t)
            if len(held) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)

    none = lambda kind: F.lit(None).cast(kind)
    rows = counted(chats).select("conv_id", F.lit(1).alias("after"), "turn", "role", "text", "n", none("string").alias("audit"))
    heads = reports.select("conv_id", F.lit(0).alias("after"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("long").alias("n"), "audit")
    dealt = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "after", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text", "n", "audit").mapInArrow(run, "conv_id long, place long, edit string, role string, text string")


def damage(chats: DataFrame) -> DataFrame:
    """Conversations damaged by the checksum of ``conv_id:turn``, modulo 20: 0 drops the
    row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it a user's.
    A null value counts as one blank."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn"))) % 20
    rows = chats.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind"))

    def when(kind: int, value: Column, other: str) -> Column:
        return F.when(F.col("kind") == kind, value).otherwise(F.col(other))

    text = F.when(F.col("kind") == 0, "").when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", when(4, F.lit("user"), "role").alias("role"), text.alias("text"), copies.alias("copies"))
