"""Diagonal voting against a plain scan for phrases."""

import random
import re

import pytest

from trustfold.llm.licenses import NOTICES, PHRASES, TEXTS, scan, template_grams, template_table

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words, starts, labels = WORD.findall((text or "").encode().lower()), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.encode().split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_all_places_of_phrases(spark):
    rng = random.Random(1)
    parts = ["the", "mit", "license", "Apache", "LICENSE,", "version", "2", "cc", "by", "nc", "x", "the MIT license", "Apache License, Version 2", "CC BY-NC"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(150)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (2, "other words")]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((tuple(r[c] for c in names) for r in got), key=str) == sorted(((d, *base(t)) for d, t in rows), key=str)
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) for r in got if r["base_labels"])


def test_the_phrase_of_the_contract(spark):
    """The base phrase is "under the mit license"; "the mit license" alone is a label of the method and no base place."""
    rows = [(1, "Under THE mit-license, under the MIT License."), (2, "the mit license"), (3, "x under the the mit license under the mit"), (4, "The MIT license; under the mit license")]
    got = {r["doc_id"]: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    assert [tuple(got[i][c] for c in names) for i in (1, 2, 3, 4)] == [
        (8, 2, 0, 4, "mit", "mit"), (3, 0, None, None, "", "mit"), (9, 0, None, None, "", "mit"), (7, 1, 3, 3, "mit", "mit")]


def test_every_notice_and_text_gives_its_label(spark):
    wanted = {**NOTICES, **TEXTS}
    rows = [(i, f"Some words before: {t.upper()}. And {i} behind") for i, t in enumerate(wanted)]
    got = {r["doc_id"]: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (t, label) in enumerate(wanted.items()):
        assert label in got[i]["labels"].split(","), t
        assert (label, 3, 3 + len(t.split()), 1.0) in [tuple(s) for s in got[i]["spans"]] and got[i]["score"] == 1


def verified(text, templates, k=3, shift=2, cover=0.9):
    """Spans of every template by plain Python: votes by diagonal, neighbours merged, the share of words they cover."""
    words, out = (text or "").lower().split(), []
    for t, label, _ in templates:
        tw = t.split()
        diagonals = {}
        for i in range(len(words) - k + 1):
            for j in range(len(tw) - k + 1):
                if words[i : i + k] == tw[j : j + k]:
                    diagonals.setdefault(i - j, set()).add(j)
        run, last = [], None
        for d in [*sorted(diagonals), None]:
            if run and (d is None or d - last > shift):
                votes = set().union(*(diagonals[x] for x in run))
                covered = len({j + o for j in votes for o in range(k)}) / len(tw)
                if covered >= cover:
                    out.append((label, min(x + min(diagonals[x]) for x in run), max(x + max(diagonals[x]) for x in run) + k, covered))
                run = []
            if d is not None:
                run.append(d)
                last = d
    return sorted(out)


@pytest.mark.parametrize("sent", [100_000, 0])
def test_a_large_template_table_against_plain_python(spark, monkeypatch, sent):
    """200 templates of 60 words, sent or joined by a shuffle, in texts with words changed, dropped and added."""
    import trustfold.llm.licenses as module

    monkeypatch.setattr(module, "SENT_GRAMS", sent)
    rng = random.Random(3)
    templates = [(" ".join(f"w{rng.randrange(300)}" for _ in range(60)), f"l{i % 40}", False) for i in range(200)] + [("w1 w2 w3", "p", True)]
    rows = []
    for d in range(25):
        words = []
        for _ in range(3):
            t = rng.choice(templates)[0].split()
            for _ in range(rng.choice([0, 1, 3])):
                at = rng.randrange(len(t))
                t[at : at + rng.choice([0, 1])] = rng.choice([[], ["new"]])
            words += [*t, "between"]
        rows.append((d, " ".join(words)))
    table = spark.createDataFrame(templates, "text string, label string, phrase boolean")
    got = scan(spark.createDataFrame(rows, "doc_id long, text string"), table).collect()
    want = {d: verified(t, templates) for d, t in rows}
    assert sum(map(len, want.values())) > 40
    for r in got:
        assert [(s["label"], s["from"], s["to"], round(s["cover"], 9)) for s in r["spans"]] == [(*w[:3], round(w[3], 9)) for w in want[r["doc_id"]]]


def test_notices_with_a_word_more_or_less(spark):
    text = next(t for t, label in NOTICES.items() if label == "bsd")
    words = text.split()
    rows = [(1, "Foo. " + text.upper() + " bar"), (2, " ".join(words[:8] + ["indeed"] + words[8:])), (3, " ".join(words[:9])),
            (4, "under the terms of the gnu general license")]
    got = {r["doc_id"]: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["labels"] for i in (1, 2, 3, 4)] == ["bsd", "bsd", "", ""]
    assert [tuple(s)[:3] for s in got[1]["spans"]] == [("bsd", 1, 1 + len(words))]
    assert got[1]["score"] == 1 and 0 < got[3]["score"] < 0.9


def test_short_templates_are_refused(spark):
    with pytest.raises(ValueError):
        template_grams(template_table(spark, {}, {"too short": "x"}), 3)


def test_odd_rows(odd, nothing):
    got = {(r["doc_id"], r["n_words"], r["labels"]) for r in scan(odd).collect()}
    assert (None, 3, "mit") in got and (2, 0, "") in got and (4, 30_001, "") in got
    assert scan(odd).count() == odd.count() and scan(nothing).count() == 0
