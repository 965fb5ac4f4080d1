"""Token counts against the tokenizers library itself."""

import random

import pytest
from tokenizers import Tokenizer

from trustfold.llm.tables import frequent
from trustfold.llm.token_counts import PreTokenizer, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


PARTS = [" ", "  ", "\n", "\t", "a", "b", "é", "1", "'s", "'", "!", "<|endoftext|>", "　", "\x1c", "\x85", " x", "\u00a0", "😀", "ll", "'ll", "_", "\r\n", "日本", "ß.", "Word,"]


def test_any_text_counts_as_the_library_counts_it(definition):
    rng, read, library = random.Random(5), PreTokenizer(definition), Tokenizer.from_str(definition)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20)))
        found, special = read(text)
        assert special + sum(c * read.pieces(p) for p, c in found.items()) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("head", [0, 300, 300_000])
def test_documents(spark, docs, definition, head):
    library = Tokenizer.from_str(definition)
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(docs, definition, head_size=head).collect()}
    for r in docs.collect():
        n = len(library.encode(r["text"], add_special_tokens=False).ids)
        assert got[r["doc_id"]] == (len(r["text"].encode()), n, n > 512)


def test_head_is_bounded_and_frequent(spark):
    df = spark.createDataFrame([(f"p{i}", i) for i in range(1, 200)], "pretoken string, n long")
    got = {r.pretoken for r in frequent(df, "n", 50).collect()}
    assert 0 < len(got) <= 50 and min(int(p[1:]) for p in got) > max(i for i in range(1, 200) if f"p{i}" not in got)
    assert frequent(df.limit(0), "n", 50).count() == 0


def test_odd_rows(odd, nothing, definition):
    library = Tokenizer.from_str(definition)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect()), key=str)
    got = token_counts(odd, definition, head_size=2)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got.collect()), key=str) == want
    assert token_counts(nothing, definition).count() == 0
