"""Toxicity features, lexicon, fitting and held-out accuracy."""

import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trustfold.llm import toxicity as t


def named(text, learned=None):
    return dict(zip(t.FEATURES, t.features(text, learned or {})))


def test_features_of_small_texts():
    f = named("You are an IDIOT!! you 1d10t\nfine", {"fine": 3.0})
    assert f["seed_any"] == 1 and f["seed_density"] == 2 / 7 and f["learned_any"] == 1 and f["learned_max"] == 3.0
    assert f["second_density"] == 2 / 7 and f["near_second"] == 3 / 7 and f["masked_density"] == 1 / 7 and f["obfuscated_density"] == 1 / 7
    assert f["exclaim_density"] == 2 / 7 and f["line_length"] == 33 / 2 and f["shout_share"] == 1 / 7
    assert named("noooo way")["stretched"] == 2 / 9
    assert named("i d i o t x y z")["spaced_letters"] > 0
    for empty in (None, ""):
        assert set(t.features(empty, {})) == {0.0}
    assert len(t.features("😀 " * 5, {})) == len(t.FEATURES)


@pytest.mark.parametrize("text", ["i.d.i.o.t", "you i-d-i-o-t", "i*d*i*o*t", "s c u m!", "so d.u m-b"])
def test_letters_apart_by_any_mark_are_seen(text):
    f = named(text)
    assert f["spaced_letters"] * len(t._WORD.findall(text)) > 0


@pytest.mark.parametrize("text", ["a.b", "e.g. this", "well-known u.s. word", "a b c"])
def test_few_letters_apart_are_none(text):
    assert named(text)["spaced_letters"] == 0


def test_reader_tells_the_same_with_a_full_memory(monkeypatch):
    texts = ["you idiot, you", "fine words here", "idiot", "you idiot, you"]
    free = t.Reader({})
    monkeypatch.setattr(t.Reader, "KEEP", 1)
    full = t.Reader({})
    assert [free(x) for x in texts] == [full(x) for x in texts]


def test_lexicon_takes_words_of_toxic_documents_only(spark):
    rows = [(1, f"common bad word{i}") for i in range(12)] + [(0, f"common fine word{i}") for i in range(40)]
    got = t.learn_lexicon(spark.createDataFrame(rows, "toxic int, text string"))
    assert set(got) == {"bad"}
    assert t.learn_lexicon(spark.createDataFrame(rows[:12], "toxic int, text string")) == {}


@pytest.fixture(scope="module")
def scored(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    return t.toxicity_scores(docs, labels).cache(), labels


def test_held_out_accuracy(scored):
    scores, labels = scored
    rows = scores.join(labels, "doc_id").select("held_out", "score", "predicted", "toxic", "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) >= 0.97
    found = [r["predicted"] for r in held if r["toxic"]]
    assert sum(found) / len(found) >= 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_do_not_move_scores(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(t.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in t.toxicity_scores(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, None), (4, 0, 1), (5, 0, None), (None, 1, 1), (6, None, 0)], "doc_id long, toxic int, quality int")
    got = t.toxicity_scores(odd, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == odd.count()
    assert got.filter("score is null or predicted is null or held_out is null").count() == 0
    assert t.toxicity_scores(nothing, labels).count() == 0
    assert t.toxicity_scores(odd, labels.limit(0)).filter("score = 0 and predicted = 0").count() == odd.count()
    kept = t.drop_toxic(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_a_text_goes_to_python_once(spark, odd, monkeypatch):
    sent, real = [], type(odd).mapInArrow
    monkeypatch.setattr(type(odd), "mapInArrow", lambda self, *a, **k: sent.append(self.schema) or real(self, *a, **k))
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")
    kept = t.drop_toxic(odd, labels, reject_from=2.0)
    assert [f.dataType for f in sent[-1]] == [f.dataType for f in odd.schema]
    plain = lambda df: sorted(map(repr, df.collect()))
    assert kept.schema.names == odd.schema.names and plain(kept) == plain(odd)
    numbers = odd.withColumn("text", F.length("text"))  # a text column of another type, named in another case
    assert plain(t.drop_toxic(numbers, labels, text_column="TEXT", reject_from=2.0)) == plain(numbers)


def test_words_are_sent_on_within_a_batch(monkeypatch):
    rows = [(i % 3 == 0, f"word{i} common w{i % 50}") for i in range(400)] + [(None, None), (1, "")]
    batch = pa.RecordBatch.from_arrays([pa.array([None if x is None else int(x) for x, _ in rows], pa.int32()), pa.array([x for _, x in rows])], names=["toxic", "text"])
    monkeypatch.setattr(t, "COUNTED_WORDS", 60)
    out = list(t._document_words([batch]))
    assert len(out) > 4 and max(b.num_rows for b in out) < 70
    got = {}
    for word, bad, good in (r.values() for b in out for r in b.to_pylist()):
        x, y = got.get(word, (0, 0))
        got[word] = (x + bad, y + good)
    assert got["common"] == (sum(bool(x) for x, _ in rows[:400]), sum(not x for x, _ in rows[:400])) and len(got) == 451
