import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keelson.llm import packing, tokenise
from keelson.llm.queries import bpe_ranks
from tests.llm.conftest import random_texts

SMALL = packing.Packing(length=64, window=4, least=8, group_tokens=20_000)


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def ids_of(reference, text):
    return [*reference.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_reference_tokenizer(docs, reference):
    enc = tokenise.encoder(bpe_ranks())
    texts = [r.text for r in docs.select("text").collect() if not r.text or len(r.text) < 30_000]
    texts += random_texts(800, "ab c's \n\t  1234!?#é😀你<|endoftext|>'llABC.-", 80)
    for t in texts:
        assert tokenise.token_ids(enc, t).tolist() == ids_of(reference, t), repr(t)


def test_ids_of_long_texts_and_long_white_space(docs, reference, monkeypatch):
    enc = tokenise.encoder(bpe_ranks())
    texts = [r.text for r in docs.where("length(text) >= 30000").select("text").collect()]
    assert texts
    run = 2_000_000
    texts += [" " * run, "\n" * run, "a" + " " * run + "b", "a\n" + "\n" * run + " b\u3000", "x" + " \t\r\n\u3000\x85" * (run // 6) + "<|endoftext|> y" + "\xa0" * run + "\x1c"]
    for t in texts:
        assert tokenise.token_ids(enc, t).tolist() == ids_of(reference, t), repr(t[:50])
    short = random_texts(1500, "ab \n\t \u2003\x85\x1c <|endoftext|>1.", 60, 9) + ["   <|endoftext|>   a", "    ", "a    ", "    a"]
    monkeypatch.setattr(tokenise, "LONG", 3)
    monkeypatch.setattr(tokenise, "LONG_RUN", tokenise.re.compile(tokenise.LONG_RUN.pattern.replace(str(1 << 16), "3")))
    for t in short:
        assert tokenise.token_ids(enc, t).tolist() == ids_of(reference, t), repr(t)


@pytest.mark.parametrize("size", [SMALL, packing.Packing()])
def test_pieces_hold_every_id_once(docs, reference, size):
    rows = packing.pack(docs, bpe_ranks(), size).collect()
    texts: dict = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(np.array(ids_of(reference, r.text), "<u4"))
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc, ps in pieces.items():
        want = texts[doc]
        assert sum(p.length for p in ps) == sum(map(len, want))
        for p in ps:
            assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in want)
        if len(want) == 1:
            at = 0
            for p in sorted(ps, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size.length and at & (at - 1) == 0  # full, or a power of two: no padding


def test_round_robin_keeps_proportions():
    rng = np.random.default_rng(1)
    shares = [0.6, 0.25, 0.1, 0.05]
    queues = [[int(x) for x in rng.integers(1, 900, int(4000 * s))] for s in shares]
    total = [sum(q) for q in queues]
    share = [t / sum(total) for t in total]
    served, seen, window = [0] * 4, 0, 1024
    for (s, _), _, n in packing.round_robin([list(q) for q in queues], share, [0.0] * 4, window, 64):
        served[s] += n
        seen += n
        if seen < 0.95 * sum(total):
            for k in range(4):
                assert abs(served[k] - share[k] * seen) <= window + 64
    assert served == total


def test_round_robin_ends_for_any_weights_and_debts():
    for share, owed in (([0.0, 1.0], [0.0, 0.0]), ([0.5, 0.5], [-5000.0, 3000.0]), ([0.0, 0.0], [0.0, -1e6])):
        got = [0, 0]
        for (s, _), _, n in packing.round_robin([[10, 700, 1], [5, 5]], list(share), list(owed), 256, 64):
            got[s] += n
        assert got == [711, 10]


def test_windows_hold_the_mix(spark):
    rows = [(i, f"s{(0 if i % 3 == 0 else i % 5)}", ("word " * (5 + i % 90)).strip()) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    out = packing.pack(df, bpe_ranks(), packing.Packing(length=256, window=8, least=16, group_tokens=40_000)).toPandas()
    share = out.groupby("source").length.sum() / out.length.sum()
    wide = out.assign(w=out.sequence_id // 8).pivot_table(index="w", columns="source", values="length", aggfunc="sum", fill_value=0)
    full = wide[wide.sum(axis=1) == 2048] / 2048
    assert len(full) > 50 and float((full - share).abs().mean().mean()) < 0.03


def test_given_weights_lead(spark):
    rows = [(i, "a" if i % 2 else "b", "word " * 50) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(2)
    out = packing.pack(df, bpe_ranks(), SMALL, {"a": 0.8, "b": 0.2}).toPandas().sort_values(["sequence_id", "offset"])
    first = out[out.sequence_id.isin(sorted(out.sequence_id.unique())[:100])]
    share = first.groupby("source").length.sum() / first.length.sum()
    assert share["a"] == pytest.approx(0.8, abs=0.05)


def test_a_row_that_fills_a_third_of_the_table_is_dealt_to_many_groups(spark):
    rows = [(i, "b", f"word{i} " * 20) for i in range(600)] + [(-1, "a", "again " * 30)] * 1200
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    size = packing.Packing(length=64, window=4, least=8, group_tokens=10_000)
    out = packing.pack(df, bpe_ranks(), size).toPandas()
    groups = out.assign(group=out.sequence_id // 2**32).groupby("group").length.sum()
    assert len(groups) > 4 and groups.max() < 2 * size.group_tokens
    again = out[out.doc_id == -1]
    assert again.length.sum() == 1200 * again.doc_tokens.iloc[0]


@pytest.mark.parametrize("each", [1, 2, 3])
def test_many_small_sources_are_dealt_to_many_groups(spark, each):
    rows = [(i, f"host{i // each}", f"word{i} " * 30) for i in range(1800)] + [(-i - 1, "big", f"word{i} " * 30) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    size = packing.Packing(length=64, window=4, least=8, group_tokens=15_000)
    out = packing.pack(df, bpe_ranks(), size).toPandas()
    groups = out.assign(group=out.sequence_id // 2**32).groupby("group").length.sum()
    assert len(groups) > 8 and groups.max() < 1.6 * size.group_tokens
    assert out.doc_id.nunique() == len(rows) and out.length.sum() == out.groupby("doc_id").doc_tokens.first().sum()


def test_round_robin_looks_only_at_sources_that_are_due():
    import time

    n = 6000
    queues, start = [[500, 300] for _ in range(n)], time.process_time()
    runs = list(packing.round_robin(queues, [1 / n / 50] * n, [i / n * -400.0 for i in range(n)], 8192, 64))
    assert sum(k for _, _, k in runs) == 800 * n
    assert time.process_time() - start < 5


def test_empty_table_and_extra_columns(none, edges):
    assert packing.pack(none, bpe_ranks()).isEmpty()
    assert packing.pack(edges, bpe_ranks()).select("doc_id").distinct().count() == 11
