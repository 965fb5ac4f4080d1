"""Ids and decoded texts against the sentencepiece library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from trustfold.llm.sentencepieces import Segmenter, _unzip, _zip, chunks_of, digests, pieces_and_texts

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


PARTS = [" ", "  ", "   ", "\n", "\t", "a", "the", "é", "1", "'s", "<s>", "</s>", "<unk>", "<0x41>", "▁", "▁▁", "　", "\x00", " ", "😀", "日本", "ß.", "Word,", "ﬁ", "①", "é"]


def test_chunks_of_any_text_give_the_library_ids(model):
    rng, segmenter = random.Random(11), Segmenter(model)
    texts = ["", " ", "  ", "▁", "a ", " a", *("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(3000))]
    for text in texts:
        assert [i for ids in segmenter.ids(chunks_of(text)) for i in ids] == segmenter.library.encode(text), repr(text)


@pytest.mark.parametrize("head", [0, 300, 750_000])
def test_documents(spark, docs, model, head):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in pieces_and_texts(docs, model, head_size=head).collect()}
    want = {r["doc_id"]: library.encode(r["text"]) for r in docs.collect()}
    assert got == {i: (ids, library.decode(ids)) for i, ids in want.items()}


def test_ids_of_any_type_and_small_batches(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(2)
    rows = [(f"id{i % 50}", "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    df = spark.createDataFrame(rows, "`the id` string, text string").repartition(3)
    got = sorted((r["the id"], r["ids"]) for r in pieces_and_texts(df, model, id_column="the id", head_size=10, batch_bytes=150).collect())
    assert got == sorted((i, library.encode(t)) for i, t in rows)


def test_numbers_survive_packing():
    for values in ([], [0], [0, 255, 256, 2**24 + 1, 2**32 - 1]):
        assert _unzip(_zip(np.array(values, np.int64))).tolist() == values


def test_digests(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    df = spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string")
    ids = library.encode("two words")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(map(tuple, digests(pieces_and_texts(df, model)).collect())) == [(1, len(ids), sha(",".join(map(str, ids))), sha("two words")), (2, 0, sha(""), sha(""))]


def test_odd_rows(odd, nothing, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    want = sorted(((r["doc_id"], library.encode(r["text"] or "")) for r in odd.collect()), key=str)
    for head, size in ((0, 1), (2, 100_000), (1000, 8 << 20)):
        got = pieces_and_texts(odd, model, head_size=head, batch_bytes=size)
        assert got.columns == ["doc_id", "ids", "decoded"]
        assert sorted(((r["doc_id"], r["ids"]) for r in got.collect()), key=str) == want
    assert pieces_and_texts(nothing, model).count() == 0


def test_a_model_that_changes_texts_is_refused(monkeypatch, model):
    class Other:
        def __init__(self, model_proto):
            self.real = sentencepiece.SentencePieceProcessor.__new__(sentencepiece.SentencePieceProcessor)

        def get_piece_size(self):
            return 2

        def id_to_piece(self, i):
            return ["▁a", "b▁c"][i]

    import sys
    import types

    monkeypatch.setitem(sys.modules, "sentencepiece", types.SimpleNamespace(SentencePieceProcessor=Other))
    with pytest.raises(ValueError, match="cross whitespace"):
        Segmenter(model)
