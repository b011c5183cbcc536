import pytest
from pyspark.sql import functions as F

from keelson.llm import mixing
from tests.llm import plain


def taken(df, mix=None):
    got, order = mixing.mix_sources(df, mix)
    return [r.asDict() for r in mixing.shares(got).collect()], order


@pytest.fixture(scope="module")
def mixed(docs):
    return taken(docs, mixing.Mix(block=64, rows_per_bucket=16, chunk=32))


def test_sizes_and_targets_equal_plain_ones(docs, mixed):
    sizes: dict = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(plain.words(r.text))
    want = plain.targets(sizes)
    for r in mixed[0]:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])


def test_taken_comes_to_the_target(docs, mixed):
    by: dict = {}
    for r in mixed[0]:
        assert r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], [r["target"], 0])[1] += r["taken"] * r["copies"]
    assert sum(r["copies"] for r in mixed[0]) == docs.count()
    for target, got in by.values():
        assert target - 1 - 3 <= got <= target + 1e-6  # copies of a row share evenly, rounded down


def test_reruns_and_other_partitions_agree(docs, mixed):
    again, _ = taken(docs.repartition(7), mixing.Mix(block=64, rows_per_bucket=16, chunk=32))
    key = lambda r: str(sorted(r.items(), key=lambda x: x[0]))
    assert sorted(map(key, again)) == sorted(map(key, mixed[0]))


def test_every_stretch_is_joined_once_to_a_slot(mixed):
    rows = mixed[1].collect()
    seen = set()
    for r in rows:
        at = (r.source, r.epoch, r.doc_id, r.h, r["first"])
        assert at not in seen and r.words > 0
        seen.add(at)
    slots: dict = {}
    for r in rows:
        slots.setdefault(r.slot, set()).add(r.source)
    last = max(slots)
    assert all(len(s) == 1 for k, s in slots.items() if k != last)  # the last number holds the late slots


def test_any_run_of_slots_is_near_the_weights(spark):
    plan = spark.createDataFrame([("a", 0, 500), ("b", 1, 300), (None, 2, 200)], "source string, rank long, wanted long")
    rows = mixing.schedule(plan, mixing.Mix(chunk=64)).orderBy("slot").collect()
    assert sorted((str(r.source), r.k) for r in rows) == sorted((str(s), k) for s, n in (("a", 500), ("b", 300), (None, 200)) for k in range(n))
    order = [r.source for r in rows]
    for start in range(0, 900, 50):
        run = order[start : start + 100]
        for s, share in (("a", 0.5), ("b", 0.3), (None, 0.2)):
            assert abs(run.count(s) - 100 * share) <= 5


def test_apply_repeats_cuts_and_drops(docs, mixed):
    given = {}
    for r in docs.collect():
        given.setdefault((r.doc_id, r.source, r.text), 0)
    out = mixing.apply_mix(docs, mixing.Mix(block=64, rows_per_bucket=16, chunk=32))
    assert out.columns == docs.columns
    words: dict = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(plain.words(r.text))
        assert r.n_chars is None or r.n_chars == len(r.text) or (r.doc_id, r.source, r.text) in given
    want: dict = {}
    for r in mixed[0]:
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"] * r["copies"]
    assert words == {k: v for k, v in want.items() if v}


def test_copies_of_a_row_are_taken_whole_one_after_the_other(spark):
    one, two = "once", "first second third"
    rows = [(1, one, "a", 4)] * 5000 + [(2, "b " * 4000, "b", 8000), (3, two, "c", 18)] + [(None, two, None, 18)] * 700 + [(4, "d " * 2000, None, 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)
    mix = mixing.Mix(weights=(1.0, 1.0, 1.0, 1.0), share=0.5, block=64, chunk=32)
    got, _ = taken(df, mix)
    assert sum(r["copies"] for r in got) == len(rows)
    for s in ("a", "b", None):
        mine = [r for r in got if r["source"] == s]
        assert sum(r["taken"] * r["copies"] for r in mine) == int(mine[0]["target"]) > 0
    want: dict = {}
    for r in got:
        for _ in range(r["copies"]):
            want.setdefault(r["doc_id"], []).append(r["taken"])
    out: dict = {}
    for r in mixing.apply_mix(df, mix).collect():
        out.setdefault(r.doc_id, []).append(r.text)
    for i, texts in out.items():
        assert sum(len(plain.words(t)) for t in texts) == sum(want[i])
    assert set(out[1]) == {one}
    assert sum(t != two for t in out.get(None, [])) <= 1 and two in out[None]
    twice, _ = taken(df, mixing.Mix(weights=(1.0, 1.0, 1.0, 1.0), share=1.5, block=64, chunk=32))
    assert all(r["taken"] <= 2 * r["size"] for r in twice) and sum(r["taken"] * r["copies"] for r in twice if r["source"] == "a") == int(next(r["target"] for r in twice if r["source"] == "a"))


def test_empty_and_wordless_tables(none, edges):
    got, order = mixing.mix_sources(none)
    assert got.isEmpty() and order.isEmpty() and mixing.apply_mix(none).isEmpty()
    got, _ = mixing.mix_sources(edges.where("text is null or trim(text) = ''"))
    assert got.agg(F.sum("taken")).first()[0] == 0
    assert mixing.apply_mix(edges).columns == edges.columns


def test_running_sum_over_blocks(spark):
    from keelson.llm.common import running_sum

    rows = [(k, i, (7 * i) % 13) for k in ("a", None) for i in range(0, 60, 1 if k else 3)]
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(3)
    for keys, part in ((["k"], df), ([], df.where("k = 'a'"))):
        for r in running_sum(part, keys, "i", "v", "s", block=8).collect():
            assert r.s == sum(v for k, i, v in rows if k == r.k and i < r.i)


def test_a_source_for_every_document(spark):
    """200,000 sources: every one comes to its target, which is the level or its cap."""
    n = 200_000
    df = spark.range(n).select(
        F.col("id").alias("doc_id"), F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 7).cast("int")), " ").alias("text"), F.format_string("s%06d", "id").alias("source"), F.lit(0).cast("long").alias("n_chars")
    )
    got, order = mixing.mix_sources(df)
    each = got.select("doc_id", "size", "source_size", "target", "taken").collect()
    assert len(each) == n
    sizes = {f"s{i:06d}": i % 7 for i in range(n)}
    want = plain.targets(sizes)
    assert all(r.target == pytest.approx(want[f"s{r.doc_id:06d}"]) and r.taken == int(r.target) for r in each)
    assert order.select("source").distinct().count() == sum(r.taken > 0 for r in each)


def test_levels_with_ties_and_wordless_sources(spark):
    for sizes in ({"a": 0, "b": 0}, {"a": 10, "b": 10, "c": 10}, {"a": 0, "b": 1, "c": 1000, None: 3}, {f"s{i}": 2**i for i in range(24)}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df, mixing.Mix()).collect()}
        want = plain.targets(sizes)
        assert got == {s: pytest.approx(want[s]) for s in sizes}
