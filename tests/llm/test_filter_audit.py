"""The filter audit against applying the filters one after the other, order by order."""

import random
import re
from itertools import permutations

import pytest

from trustfold.llm.filter_audit import filter_audit, packed, removals


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None}


def expected(rows, marks):
    """Rows (doc_id, text, source); marks doc_id -> (good, toxic)."""
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    state = []
    for d, t, s in rows:
        f = fails(t or "")
        f["E"] = d is not None and first[t or ""] < d
        state.append((s or "", f, *marks.get(d, (False, False))))
    out = {}
    for part in {s for s, *_ in state}:
        own = [x[1:] for x in state if x[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if x[0][letter]]
                left = [x for x in left if not x[0][letter]]
                shapley[letter] += len(gone)
                redundant = sum(x[0][letter] for x in own) - len(gone)
                alone = sum(x[0][letter] and sum(x[0].values()) == 1 for x in own)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, alone, sum(x[1] for x in gone), sum(x[2] for x in gone), letter]
        for v in out.values():
            if len(v) == 7 and isinstance(v[6], str):
                v[6] = shapley[v[6]]
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
            for r in df.collect()}


def test_fields_of_a_mask():
    table = packed("AB")  # orders AB, BA: fields AB1 AB2 BA1 BA2
    one = lambda x: [x >> 64 * i & (2**64 - 1) for i in range(12)]
    assert one(table[0]) == [1, 1, 1, 1] + [0] * 8
    assert one(table[1]) == [0, 0, 1, 0, 1, 0, 0, 1, 0, 0, 0, 0]  # A fails: kept by B first, removed by A
    assert one(table[3]) == [0] * 4 + [1, 0, 1, 0] + [0, 1, 0, 1]
    assert removals(table[3], "AB") == 1 + (1 << 128)


def test_random_documents(spark):
    rng = random.Random(12)
    pool = ["word", "other", "Caps", "BIG", "x|y", "&", "#tag", "é", *(f"w{i}" for i in range(80))]
    rows = []
    for i in range(160):
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1]
        else:
            text = rng.choice([" ", "\t", "\n "]).join(rng.choice(pool[: rng.choice([4, 8, len(pool)])]) for _ in range(rng.choice([0, 3, 49, 50, 51, 90])))
            text = rng.choice([text, " " + text, text + "\r\n", text + " "])
        rows.append((rng.choice([i, i, i, 500 - i, None]), rng.choice([text] * 9 + [None]), rng.choice(["s1", "s1", "s2", "", None])))
    marks = {i: (rng.random() < 0.5, rng.random() < 0.3) for i in range(0, 500, 2)}
    labels = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in marks.items()] + [(i, 0, None) for i in range(0, 100, 2)] + [(None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, part string").repartition(3)
    assert found(filter_audit(docs, labels)) == expected(rows, marks)


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    assert found(filter_audit(odd, labels)) == expected(rows, {1: (True, True)})
    assert filter_audit(nothing, labels).count() == 0


@pytest.mark.parametrize("hot", [3000])
def test_one_text_in_a_third_of_all_rows(spark, hot):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}", "hot" if i % 2 else "cold") for i in range(hot)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found(filter_audit(docs, labels)) == expected(rows, {})
