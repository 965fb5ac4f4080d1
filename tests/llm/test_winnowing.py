"""Winnowing against its definition, match guarantee, edited texts."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trustfold.llm import winnowing as w


def plain(text, k, window):
    p = w._points(text)
    if not len(p):
        return [], []
    k = min(k, len(p))
    h = [int(w.gram_hashes(p[i : i + k], k)[0]) for i in range(len(p) - k + 1)]
    window, out = min(window, len(h)), []
    for i in range(len(h) - window + 1):
        least = min(h[i : i + window])
        at = max(j for j in range(i, i + window) if h[j] == least)
        if not out or out[-1] != at:
            out.append(at)
    return out, [h[j] for j in out]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é😀"), max_size=40), max_size=5), st.integers(1, 5), st.integers(1, 7), st.sampled_from([30, 1 << 19]))
def test_choice_of_every_window(texts, k, window, tile):
    before, w.TILE = w.TILE, tile
    try:
        got = w.winnow(texts, k, window)
    finally:
        w.TILE = before
    for text, (at, h) in zip(texts, got):
        assert (at.tolist(), h.tolist()) == plain(text, k, window)


def test_common_substrings_of_guaranteed_length_share_a_hash():
    rng = random.Random(8)
    say = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    for _ in range(50):
        k, window = rng.randint(2, 6), rng.randint(2, 8)
        common = say(k + window - 1)
        a, b = say(rng.randint(0, 50)) + common + say(9), say(rng.randint(0, 50)) + common + say(20)
        (_, x), (_, y) = w.winnow([a, b], k, window)
        assert set(x.tolist()) & set(y.tolist())


def test_likeness():
    (_, a), (_, b), (_, none) = w.winnow(["some words of a text", "some words of a test", ""], 4, 3)
    assert w.likeness(a, a) == 1 and 0 < w.likeness(a, b) < 1 and w.likeness(none, none) == 1 and w.likeness(a, none) == 0


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = []
    for i, r in enumerate(order):
        t, after = texts[i], texts[(i + 1) % len(order)]
        e = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        want.append((r[0], len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], key=str) == sorted(want, key=str)


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_edited_texts_over_ranges(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.randint(-20, 60), "".join(rng.choice("abc d") for _ in range(rng.randint(0, 90)))) for _ in range(50)]
    rows += [(None, "no id"), (None, None), (7, rows[0][1]), rows[3], rows[3]]
    got = w.with_edits(spark.createDataFrame(rows, "doc_id long, text string"), k=4, window=5, ranges=ranges).collect()
    check(rows, got)
    by = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_equal_texts_have_equal_fingerprints_and_one_document_is_its_own_next(spark, docs):
    got = w.with_edits(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    by = {}
    for r in got:
        assert by.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
    alone = w.with_edits(docs.limit(1)).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1


def test_odd_rows(odd, nothing):
    got = w.with_edits(odd).collect()
    check([(r["doc_id"], r["text"]) for r in odd.collect()], got)
    assert {r["fingerprint"] for r in got if r["doc_id"] in (2, 3)} == {""}
    assert w.with_edits(nothing).count() == 0
    assert w.fingerprints(odd).count() == odd.count()
