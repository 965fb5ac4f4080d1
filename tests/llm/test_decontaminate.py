"""FM-index search, hits and removal against plain scans."""

import hashlib
import random
import re

import numpy as np
import pytest

from trustfold.llm.decontaminate import contamination, contamination_digest, decontaminated
from trustfold.llm.fm_index import FMIndex, suffix_order

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def expected(docs, items, window):
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, text in items:
            p = words(text)
            for j in range(max(1, len(p) - window + 1) if p else 0):
                q = p[j : j + window]
                for at in range(len(w) - len(q) + 1):
                    if w[at : at + len(q)] == q:
                        hit.update(range(at, at + len(q)))
                        if i is not None:
                            found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_suffix_order_search_and_location():
    rng = np.random.default_rng(1)
    for _ in range(40):
        text = rng.integers(0, 4, rng.integers(1, 60))
        text[-1] = 0
        zeros = np.cumsum(text == 0)
        # separators sort by position, before all symbols
        keys = [tuple((0, int(zeros[j])) if text[j] == 0 else (1, int(text[j])) for j in range(i, len(text))) for i in range(len(text))]
        assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: keys[i])
        index = FMIndex(text, 5)
        phrases = np.array([[1, 0, 0], [1, 2, 0], [3, 3, 1], [2, 2, 2], [4, 0, 0]])
        lengths = (phrases > 0).sum(1)
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(text) - n + 1) if text[i : i + n].tolist() == p[:n].tolist()]


def cases(seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["a", "B", "c1", "d", "é", "f"]) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, say(rng.randint(0, 9))) for i in range(12)] + [(100, None), (101, ""), (None, say(5)), (3, say(4))]
    docs = [(i, say(rng.randint(0, 40)) + " " + (rng.choice(items)[1] or "") + " " + say(3)) for i in range(60)]
    return docs + [(1, None), (2, ""), (5, docs[5][1]), (5, docs[5][1]), (None, docs[6][1])], items


@pytest.mark.parametrize("window,block", [(3, 1 << 20), (4, 60)])
def test_hits_match_a_plain_scan(spark, window, block):
    docs, items = cases(window)
    got = contamination_digest(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                               window=window, block_bytes=block)
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected(docs, items, window)


def test_spans_are_merged(spark):
    docs = spark.createDataFrame([(1, "x a b c d y a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d"), (2, "c d y")], "item_id long, text string")
    row = contamination(docs, items, window=3).first()
    assert [tuple(s) for s in row["spans"]] == [(1, 9)] and row["items"] == ["1", "2"]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_nothing_is_left_after_removal_and_clean_rows_stay(spark, block):
    docs, items = cases(9)
    df = spark.createDataFrame([(d, t, None if t is None else len(t), "c") for d, t in docs], "doc_id long, text string, n_chars long, spans string")
    item_df = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminated(df, item_df, window=4, block_bytes=block)
    assert out.columns == df.columns
    kept = [tuple(r) for r in out.collect()]
    assert not any(r[5] for r in expected([r[:2] for r in kept], items, 4))
    assert all(n is None and t is None or n == len(t) for _, t, n, _ in kept)
    clean = [r[0] for r in expected(docs, items, 4) if not r[5]]
    assert {str(d) for d in clean} <= {str(r[0]) for r in kept}
    texts = {(d, t) for d, t in docs}
    for (d, t) in texts:
        if not expected([(d, t)], items, 4)[0][5]:
            assert (d, t) in {r[:2] for r in kept}


def test_joining_what_is_left_makes_no_new_window(spark):
    df = spark.createDataFrame([(1, "go a a b c b c end")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminated(df, items, window=3, length_column=None).first()["text"].split() == ["go", "end"]


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    got = contamination_digest(odd, items)
    assert got.filter("contaminated").count() == 3 and got.count() == odd.count()
    assert contamination_digest(nothing, items).count() == 0
    assert contamination_digest(odd, items.limit(0)).filter("contaminated or n_items > 0").count() == 0
