"""Words and n-gram hashes of flat chunks against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from trustfold.llm import textarrays as ta
from trustfold.llm.textarrays import ALNUM, SPACED, chunk_of, gram_hashes, run_hash, slices, words_of

CLASSES = [(SPACED, re.compile(rb"[^\x20\x09-\x0D]+")), (ALNUM, re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))]
TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB1 \n\t.é😀_\x00\x0b"), max_size=12)), max_size=6)


@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    chunk = chunk_of(pa.array(texts, pa.string()))
    for kind, pattern in CLASSES:
        w = words_of(chunk, kind)
        raw = chunk.data.tobytes().lower()
        got = [[raw[a:b] for a, b in zip(w.start[x:y], w.end[x:y])] for x, y in zip(w.bounds, w.bounds[1:])]
        assert got == [pattern.findall((t or "").encode().lower()) for t in texts]
        assert len({(raw[a:b], h) for a, b, h in zip(w.start, w.end, w.hash.tolist())}) == len(set(w.hash.tolist()))


def test_gram_hash_depends_on_the_words_only():
    w = words_of(chunk_of(pa.array(["a b c d", "x a b c", "a b"])), SPACED)
    grams, at = gram_hashes(w, 3)
    assert at.tolist() == [0, 1, 4, 5]
    assert grams[0] == grams[3] and len(set(grams.tolist())) == 3
    assert run_hash(w.hash[:3]) == int(grams[0])
    assert gram_hashes(words_of(chunk_of(pa.array(["a"])), SPACED), 3)[0].tolist() == []


def test_slices_bound_bytes_and_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 50, "", "de", "f"])], names=["text"])
    parts = list(slices([batch], "text", 4))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 4 for p in parts)
    assert np.all(chunk_of(parts[1].column(0)).offsets >= 0)


def test_a_chunk_of_many_texts_takes_little_memory_and_hashes_as_one_text_does():
    """Texts of 4 MB in all, cut as the operators cut them: the peak of numpy's memory is a few MB, the hashes are those of single texts."""
    import tracemalloc

    from trustfold.llm.textarrays import SPACED, chunk_of, slices, words_of

    texts = [f"word{i} " * 50 + "end" for i in range(8_000)]
    batch = pa.record_batch({"text": pa.array(texts)})
    words_of(chunk_of(pa.array(["a"])), SPACED)
    tracemalloc.start()
    try:
        seen = 0
        for b in slices([batch], "text"):
            words = words_of(chunk_of(b.column(0)), SPACED)
            alone = words_of(chunk_of(b.column(0).slice(b.num_rows - 1)), SPACED)
            assert words.hash[words.bounds[-2] :].tolist() == alone.hash.tolist()
            seen += b.num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert seen == len(texts) and peak < 40 << 20, peak


def test_words_of_a_large_chunk_take_little_memory_and_are_the_same(monkeypatch):
    import tracemalloc

    texts = ["", None, "ends in a word", "word begins", " \t", "Ünd " * 30, *("some words here " * (i % 40) for i in range(9000)), "x" * 300_000, "last"]
    chunk = ta.chunk_of(pa.array(texts))
    assert len(chunk.data) > 10 * ta.CHUNK_BYTES
    monkeypatch.setattr(ta, "_powers", {})
    tracemalloc.start()
    got = ta.words_of(chunk, ta.SPACED)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    held = sum(x.nbytes for x in (got.start, got.end, got.text, got.bounds, got.hash))
    assert peak - 2 * held < 6 * len(chunk.data)
    assert max(map(len, ta._powers.values())) < 600_000
    monkeypatch.setattr(ta, "CHUNK_BYTES", 1 << 30)
    monkeypatch.setattr(ta, "powers", lambda n, inverse=False, table={}: table.setdefault(inverse, whole(len(chunk.data) + 1, inverse))[:n])
    once = ta.words_of(chunk, ta.SPACED)
    for name in ("start", "end", "text", "bounds", "hash"):
        assert np.array_equal(getattr(got, name), getattr(once, name))
    assert np.array_equal(ta.words_of(chunk, ta.SPACED, hashes=False).start, once.start)


def whole(n, inverse):
    table = np.full(n, ta._BASE_INV if inverse else ta._BASE, dtype=np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)
