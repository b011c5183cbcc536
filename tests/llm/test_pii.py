import random

from pyspark.sql import functions as F

from keelson.llm import pii
from tests.llm import plain


def spans(df):
    t = F.coalesce("text", F.lit(""))
    return [(r.text, [(x.start, x.kind, x.end) for x in r.s]) for r in df.select("text", pii.base_spans(t).alias("s")).collect()]


def test_base_spans_equal_plain_ones(docs):
    for text, got in spans(docs):
        assert got == plain.base_spans(text), (text or "")[:200]


def test_base_spans_of_random_texts(spark):
    rnd = random.Random(2)
    bits = ["1", "23", "456", "255", "4111111111111111", ".", "..", "-", " ", "+", "+1", "(", ")", "@", "a", "b-c", "%", "_", "é", "😀", "\n", "x@y.z"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(40))) for _ in range(1500)]
    texts += ["+" + "1 " * 7 + "+" + "2-" * 9 + "3", "1." * 400 + "1", "9 " * 30_000, "a.b" * 5000 + "@c.d", "0000000000000000"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(4)
    for text, got in spans(df):
        assert got == plain.base_spans(text), repr(text[:200])


def masked(text, found):
    out, at = [], 0
    for start, kind, end in found:
        if start >= at:
            out += [text[at:start], f"[{pii.KINDS[kind].upper()}]"]
        at = max(at, end)
    # text after the furthest end so far
    return "".join(out) + text[at:]


def test_added_spans_and_masks(spark, docs):
    secrets = [(i, f"some words then password={'ab12' * 4}{i:03d} and more words. Also token = \"{i:06d}{'9f3c' * 6}\" here.", "en", "s", 0) for i in range(40)]
    plainly = [(100 + i, f"Page {i} of chapter 12 has 3.14 and 1,234,567 words, see 2001-2002.", "en", "s", 0) for i in range(40)]
    all_docs = docs.unionByName(spark.createDataFrame(secrets + plainly, docs.schema))
    rows = pii.find_pii(all_docs).withColumn("m", pii.masked(F.coalesce("text", F.lit("")), F.col("all_spans"), 16)).collect()
    assert len(rows) == all_docs.count()
    for r in rows:
        base = [(x.start, x.kind, x.end) for x in r.base_spans]
        every = [(x.start, x.kind, x.end) for x in r.all_spans]
        assert base == plain.base_spans(r.text) and set(base) <= set(every) and every == sorted(every)
        assert r.m == masked(r.text or "", every)
        if r.lang == "en" and r.source == "s":
            kinds = [pii.KINDS[k] for _, k, _ in every]
            assert kinds == (["secret", "secret"] if r.doc_id < 100 else []), r.text


def test_overlapping_spans_are_masked_to_the_last_character(spark):
    rnd = random.Random(4)
    bits = ["+1 415-555-0100", "+1 415 555 0100 2", "john@x.com", "4111 1111 1111 1111", "10.0.0.1", " ", "-", ".", "7", "w", "+"]
    texts = ["call +1 415-555-0100john@x.com now", "+1 415 555 0100 2john@x.com", "4111 1111 1111 1111@x.com4111 1111 1111 1111"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randrange(12))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("s", pii.base_spans(F.col("text"))).coalesce(2)
    parted = 0
    for r in df.withColumn("m", pii.masked(F.col("text"), F.col("s"), 16)).collect():
        held = {i for x in r.s for i in range(x.start, x.end)}
        first: dict = {}  # kinds of the spans that begin inside no earlier one
        for x in r.s:
            if not any(y.start <= x.start < y.end for y in r.s if (y.start, y.kind) < (x.start, x.kind)):
                first[x.start] = f"[{pii.KINDS[x.kind].upper()}]"
        want = "".join(first.get(i, "") + ("" if i in held else c) for i, c in enumerate(r.text))
        assert r.m == want, r.text
        parted += any(x.start < y.start < x.end < y.end for x in r.s for y in r.s)
    assert parted > 20
    out = pii.mask_texts(df.select("doc_id", "text")).orderBy("doc_id").limit(2).collect()
    assert [r.text for r in out] == ["call [PHONE] now", "[PHONE]"]


def test_reruns_agree(docs):
    assert pii.fit(docs) == pii.fit(docs.repartition(5))


def test_mask_stage_keeps_columns(edges, none):
    out = pii.mask_texts(edges)
    assert out.columns == edges.columns and out.count() == edges.count()
    row = out.where("doc_id = 9008").first()
    assert row.text == "mail [EMAIL] and [IP], card [CARD], call [PHONE]." and row.n_chars == len(row.text) and row.base_spans == "own base_spans"
    assert out.where("doc_id = 9001").first().text is None
    assert pii.mask_texts(none).isEmpty()
