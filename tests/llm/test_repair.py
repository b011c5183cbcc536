import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from keelson.llm import queries, repair

CHAT = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 4:
            role = "user"
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def plain_repair(rows):
    """Report of one conversation's rows by a table over positions and states, filled by Bellman-Ford rounds."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    n = len(rows)
    best = {(0, 0): (0, "", ())}
    legal = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    while True:
        new = dict(best)

        def offer(to, weight):
            if to not in new or weight < new[to]:
                new[to] = weight

        for (i, q), (cost, audit, lines) in best.items():
            for role in ("user", "assistant"):
                if (q, role[0]) in legal:
                    offer((i, legal[q, role[0]]), (cost + 5, audit + "I", (*lines, f"{role}:")))
            if i == n:
                continue
            _, _, role, text = rows[i]
            offer((i + 1, q), (cost + 2, audit + "D", lines))
            if faults[i] in ("blank", "duplicate"):
                continue
            more = 5 if faults[i] == "truncated" else 0
            if (q, role[:1]) in legal:
                offer((i + 1, legal[q, role[:1]]), (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for to in ("user", "assistant"):
                if (q, to[0]) in legal:
                    offer((i + 1, legal[q, to[0]]), (cost + more + 1, audit + "R", (*lines, f"{to}:{text}")))
        if new == best:
            break
        best = new
    cost, audit, lines = min(best[n, q] for q in (0, 3) if (n, q) in best)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    count = Counter(faults)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha), lines


def plain(rows, damaged):
    by_conv: dict = {c: [] for c, *_ in rows}
    for r in damaged:
        by_conv[r[0]].append(r)
    return {(c, *plain_repair(rs)[0]) for c, rs in by_conv.items()}


def random_chats(n, longest, seed=1):
    rnd = random.Random(seed)
    texts = ["", " ", None, "a.", "b!", "c", "d?\n", "e. ", "f ", "g"]
    roles = ["system", "user", "assistant", "user", "assistant", "User", "", None, "tool", "s"]
    rows = []
    for c in range(n):
        turns = rnd.randrange(longest)
        rows += [(c, rnd.choice([k, k, k, k, k + 2, 0, None]), rnd.choice(roles[1:3] if rnd.random() < 0.7 else roles), rnd.choice(texts)) for k in range(turns)]
    return rows


def reports(df):
    return {tuple(r) for r in df.select(*COLUMNS).collect()}


def filled(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


@pytest.mark.parametrize("block", [256, 1, 3])
def test_random_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = random_chats(150, 9) + [(None, None, None, None), (None, 1, "user", "x."), (999, None, "assistant", "y")]
    df = spark.createDataFrame(rows, CHAT).withColumn("n", F.lit(-1)).withColumn("late", F.lit("own")).repartition(4)
    assert reports(repair.repair_conversations(df)) == plain(rows, filled(rows))


def test_stretches_join_in_any_split():
    """A conversation cut anywhere, and into single rows, gives the report of the whole."""
    for rows in (random_chats(1, 14, seed) for seed in range(60)):
        rows = sorted(((t, r, x) for _, t, r, x in filled(rows)), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, lined = set(), []
        for t, r, x in rows:
            lined.append((t, r, x, 1, (r, x) in seen))
            seen.add((r, x))

        def stretch(part, entries):
            s = repair.Stretch(entries)
            for row in part:
                s.add(*row)
            return s

        want = stretch(lined, (0,)).report()
        assert want["audit"] == plain_repair([(0, t, r, x) for t, r, x in rows])[0][6]
        cuts = [[k] for k in range(len(lined) + 1)] + [list(range(len(lined)))]
        for cut in cuts:
            edges = [0, *cut, len(lined)]
            whole = repair.Stretch.load(stretch(lined[: edges[1]], (0,)).dump(), (0,))
            for a, b in itertools.pairwise(edges[1:]):
                whole.follow(repair.Stretch.load(stretch(lined[a:b], range(4)).dump()))
            assert whole.report() == want


def test_agenda_pops_in_order_of_weight_and_stops_at_the_goal():
    edges = {"a": [("b", 3, "x"), ("c", 1, "y")], "c": [("b", 2, "a"), ("d", 9, "z")], "b": [("d", 1, "q")]}
    deduce = lambda item, w, _: (((w[0] + c, w[1] + ch), to) for to, c, ch in edges.get(item, []))
    final = repair.knuth([((0, ""), "a")], deduce)
    assert final == {"a": (0, ""), "c": (1, "y"), "b": (3, "x"), "d": (4, "xq")}
    assert list(final) == ["a", "c", "b", "d"]
    assert "d" not in repair.knuth([((0, ""), "a")], deduce, lambda item: item == "b")


def heavy_rows():
    """One conversation with most rows (equal turns and a row repeated often among them)."""
    rnd = random.Random(4)
    rows = [(1, k // 3, rnd.choice(["user", "assistant"]), f"t{rnd.randrange(300)}{rnd.choice(['.', ''])}") for k in range(900)]
    return rows + [(1, 7, "user", "again.")] * 400 + [(2, 0, "user", "a."), (2, 1, "assistant", "b."), (0, 5, "assistant", "c.")]


@pytest.mark.parametrize("hold", [repair.HOLD, 100])
def test_a_heavy_conversation_spreads_over_tasks(spark, hold):
    rows = heavy_rows()
    # copies are one row and a stretch of so few bytes would be one task's otherwise
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        got = reports(repair.repair_conversations(spark.createDataFrame(rows, CHAT).repartition(3), hold))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain(rows, rows)


def test_repaired_turns_follow_the_audit(spark):
    rows = random_chats(60, 9, 3) + heavy_rows()[:200]
    df = spark.createDataFrame(rows, CHAT).repartition(3)
    out = repair.repair_conversations(df)
    made: dict = {c: [] for c, *_ in rows}
    for r in repair.repaired_turns(df, out).orderBy("conv_id", "place").collect():
        assert r.place == len(made[r.conv_id])
        made[r.conv_id].append(f"{r.role}:{r.text}")
    shas = {r.conv_id: r.repaired_sha256 for r in out.collect()}
    for c, lines in made.items():
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == shas[c]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))


def test_damage_and_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert reports(queries.op11_conversation_repair(spark, sf)) == plain(rows, plain_damage(rows))
    odd = random_chats(200, 8, 9) + [(None, k, "user", "x.") for k in range(30)] + [(5000 + k, k, "assistant", "y.") for k in range(60)] + [(7000, None, "user", None)] * 3
    df = spark.createDataFrame(odd, CHAT).withColumn("kind", F.lit("own")).withColumn("copies", F.lit(7))
    got = reports(repair.repair_conversations(repair.damage(df)))
    assert got == plain(odd, plain_damage(odd))
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in got)  # every row dropped


def test_long_text_and_far_turns(spark):
    rows = [(1, -(2**63), "user", "x" * 3_000_000 + "?"), (1, 2**63 - 1, "assistant", " " * 2_000_000 + "."), (2, 0, "user", "q.")]
    got = {r[0]: r for r in reports(repair.repair_conversations(spark.createDataFrame(rows, CHAT)))}
    assert got[1][1] == 2**63 - 1 and got[1][6:8] == (0, "KK")
    assert got[2][7] == "D"


def test_empty_table(spark):
    none = spark.createDataFrame([], CHAT)
    out = repair.repair_conversations(none)
    assert out.isEmpty() and repair.repaired_turns(none, out).isEmpty()
