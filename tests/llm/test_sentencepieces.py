import hashlib

import pytest
from pyspark.sql import functions as F

from keelson.llm import queries
from keelson.llm import sentencepieces as pieces
from tests.llm.conftest import random_texts

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "▁▁ a▁b ", "\n", "a\t\nb", "<s>x</s> <unk>", "a\x00b", "ﬁ①　é", "你好 words 😀", "x" * 9000 + " y", " " * 5000 + "z" + " " * 33, "​ ▁▁"]


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(queries.vocabulary(queries.PIECES))


@pytest.fixture(scope="module")
def library(model):
    return pieces.processor(model)


def test_given_model_is_chunkable_and_others_are_not(model):
    from sentencepiece import sentencepiece_model_pb2 as pb

    assert pieces.chunkable(model)

    def changed(change):
        m = pb.ModelProto()
        m.ParseFromString(model)
        change(m)
        return m.SerializeToString()

    def crossing(m):
        m.pieces[500].piece = "a▁b"

    def own(m):
        m.pieces[500].type = pb.ModelProto.SentencePiece.USER_DEFINED

    def trimmed(m):
        m.normalizer_spec.remove_extra_whitespaces = True

    def unigram(m):
        m.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM

    assert not any(pieces.chunkable(changed(c)) for c in (crossing, own, trimmed, unigram))


def test_chunks_equal_the_library(library):
    texts = ODD + random_texts(1500, " ▁ab\n\t<s>é\x00　.w你", 70)
    for limit in (pieces.TABLE, 7):  # a table that starts anew all the time
        table = pieces.ChunkTable(library, limit)
        for t in texts:
            assert table.encode(t).tolist() == library.encode(t), t[:80]


def test_long_texts_are_cut_in_windows(library, monkeypatch):
    t = " ".join(f"word{i % 997}{'  ' * (i % 5)}" for i in range(20_000)) + "y" * 20_000 + "  end "
    for size in (1, 50, 4000):
        monkeypatch.setattr(pieces, "WINDOW", size)
        assert pieces.ChunkTable(library).encode(t).tolist() == library.encode(t)


def test_each_distinct_word_is_segmented_once(library):
    table = pieces.ChunkTable(library)
    for _ in range(5):
        table.encode("one two  two one three")
    assert table.segmented == 4  # " one", " two", "  two", " three"


def digest(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def test_given_and_odd_rows(spark, docs, model, library):
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, None), (7, "again"), (7, "again")], "doc_id long, text string")
    df = docs.select("doc_id", "text").union(odd).withColumn("ids", F.lit("own")).withColumn("n_tokens", F.lit(-1))
    want = []
    for r in df.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids) if ids else "")))
    got = [tuple(r) for r in queries.piece_digests(df, model).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_other_models_are_encoded_text_by_text(spark, model, library):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(model)
    m.pieces[500].piece = "ab▁ab"
    m.pieces[500].score = 100
    own = m.SerializeToString()
    df = spark.createDataFrame([(1, "ab ab ab"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in pieces.encode(df, own).collect()}
    assert got == {1: pieces.processor(own).encode("ab ab ab"), 2: []}


def test_text_comes_back_and_null_ids(spark, docs, model):
    back = pieces.decode(pieces.encode(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), model), model)
    lost = back.alias("b").join(docs.dropDuplicates(["doc_id"]).alias("d"), "doc_id").where("coalesce(d.text, '') <> b.text and instr(d.text, '▁') = 0")
    assert lost.isEmpty()
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(none, model).first().text == ""


def test_empty_table(none, model):
    assert queries.piece_digests(none, model).isEmpty()
