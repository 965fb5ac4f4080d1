"""Mergeable summaries against exact answers, digests of rows, ragged rows, odd column names."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from trustfold.functions.text import row_digest
from trustfold.operators import dedup, profile
from trustfold.operators.sketches import (
    KLL_RANK_ERROR,
    active_entities,
    entity_bitmaps,
    frequent_values_per_column,
    quantile_sketches,
    rank_errors,
    sketched_quantiles,
)
from trustfold.sources.batches import ragged_rows


@pytest.mark.parametrize("shape", ["uniform", "skewed", "few"])
def test_sketched_quantiles_stay_within_the_bound(spark, shape):
    rng = random.Random(4)
    value = {"uniform": lambda: rng.random() * 1e6, "skewed": lambda: rng.lognormvariate(0, 3), "few": lambda: rng.randint(0, 5)}[shape]
    rows = [(f"b{i % 7}", str(value()) if i % 50 else "n/a") for i in range(60_000)]
    df = spark.createDataFrame(rows, "batch string, v string").repartition(8)
    sketches = quantile_sketches(df, ["batch"], {"v": "double", "absent": "int"})
    assert sketches.count() == 7
    probs = (0.01, 0.25, 0.5, 0.75, 0.99)
    found = sketched_quantiles(sketches, probs)
    held = spark.createDataFrame(found.collect(), found.schema)
    errors = rank_errors(df, held, {"v": "double"}).collect()
    assert len(errors) == 5 and all(r.rank_error <= KLL_RANK_ERROR and r.n == 58_800 for r in errors)
    assert sketched_quantiles(sketches, (0.5,), by=["batch"]).count() == 7


def test_rank_error_of_known_values(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1, 101)], "v string")
    q = spark.createDataFrame([("v", 0.5, 50.0), ("v", 0.25, 35.0), ("v", 0.75, 60.0)], "column_name string, prob double, value double")
    got = {r.prob: round(r.rank_error, 9) for r in rank_errors(df, q, {"v": "double"}).collect()}
    assert got == {0.5: 0.0, 0.25: 0.09, 0.75: 0.15}


def test_sketches_of_columns_without_values(spark):
    df = spark.createDataFrame([("b", None), ("b", "x")], "batch string, v string")
    assert [tuple(r) for r in sketched_quantiles(quantile_sketches(df, ["batch"], {"v": "int"}), (0.5,)).collect()] == [("v", 0, 0.5, None)]
    assert sketched_quantiles(quantile_sketches(df.limit(0), ["batch"], {"v": "int"})).count() == 0


def frequent_rows(seed, n):
    rng = random.Random(seed)
    wide = lambda i: rng.choice(["hot", None, "warm"]) if rng.random() < 0.2 else f"v{i}"
    return [(wide(i), rng.choice("abc"), f"only{i}", None) for i in range(n)]


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_frequent_values_equal_the_full_count(spark, k):
    df = spark.createDataFrame(frequent_rows(k, 30_000), "wide string, few string, unique string, `no thing.` string").repartition(6)
    cols = ["wide", "few", "unique", "no thing.", "absent"]
    got = sorted(map(tuple, frequent_values_per_column(df, cols, k, tracked=2000).collect()), key=str)
    want = []
    for i, c in enumerate(cols[:4]):
        counts = Counter(r[i] for r in df.collect())
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]
        want += [(c, v, n, rank) for rank, (v, n) in enumerate(top, 1)]
    assert got == sorted(want, key=str)


def test_wide_columns_never_shuffle_their_values(spark, tmp_path):
    rows = [("hot" if i % 3 == 0 else f"v{i}",) for i in range(50_000)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "wide string").repartition(5).write.parquet(path)
    got = frequent_values_per_column(spark.read.parquet(path), ["wide"], 1)
    assert [tuple(r) for r in got.collect()] == [("wide", "hot", 16_667, 1)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # proven: nothing is left to count


def test_a_false_candidate_order_falls_back_to_the_full_count(spark):
    rows = [(f"v{i % 700}",) for i in range(7_000)] + [("v699",)]  # all but equal: a small summary cannot tell the first
    df = spark.createDataFrame(rows, "c string").repartition(4)
    assert [tuple(r) for r in frequent_values_per_column(df, ["c"], 1, tracked=50).collect()] == [("c", "v699", 11, 1)]
    assert frequent_values_per_column(df.limit(0), ["c"], 1).count() == 0


def test_active_entities_against_sets(spark):
    rng = random.Random(9)
    start = date(2026, 1, 1)
    rows = [(start + timedelta(days=rng.choice([0, 1, 2, 3, 9, 10, 20])), rng.choice([None, 0, 5, 32_768, 40_000, -3, rng.randint(0, 10**6)])) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "day date, `user id` long").repartition(5)
    bitmaps = entity_bitmaps(df, day="day", key="user id")
    got = {r.day: (r.one, r.week) for r in active_entities(bitmaps, {"one": 1, "week": 7}).collect()}
    days = {d for d, u in rows if u is not None}
    assert got == {d: (len({u for e, u in rows if e == d and u is not None}),
                       len({u for e, u in rows if d - timedelta(days=7) < e <= d and u is not None})) for d in days}
    with pytest.raises(TypeError):
        entity_bitmaps(df.withColumn("t", F.lit("x")), day="day", key="t")


def test_row_digests_see_nulls_and_positions(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None), ("a", "a"), ("", ""), (None, ""), ("", None)]
    df = spark.createDataFrame(rows + rows, "x string, `y.z` string")
    assert df.select(F.count_distinct(row_digest(["x", "y.z"]))).first()[0] == len(rows)


def test_no_sort_aggregate_and_no_wide_key(spark):
    df = spark.createDataFrame([("r/u/f1", "k", "1"), ("r/u/f2", "k", "1"), ("r/u/f2", "k", None), ("r/w/f3", "k", "1")], "_source_file string, key string, v string")
    out = dedup.collapse_identical(df, unit="folder")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("r/u/f1", "k", "1"), ("r/u/f2", "k", None), ("r/w/f3", "k", "1")], key=str)
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    kinds = profile.duplicate_kind(df.withColumn("unit", F.lit("u")), unit="unit", key="key", cols=["v"])
    assert [tuple(r) for r in kinds.collect()] == [("u", "k", 4, 2, False)]


def test_dots_and_backticks_in_column_names(spark):
    df = spark.createDataFrame([("f1", "k", "1"), ("f1", "k", "2"), ("f1", "m", "1"), ("f1", "m", "1")], ["_source_file", "the.key", "a`b"])
    ok, bad = dedup.split_conflicts(df, key="the.key")
    assert [r[1] for r in ok.collect()] == ["m"] and sorted(r[2] for r in bad.collect()) == ["1", "2"]
    assert ok.columns == df.columns


def test_ragged_rows_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,x,y\n1,2,3\n1,2\n1,2,\n\n   \n1,2,3,4\n"a,b",2,3\n"a,b",2\n1,2,3,"x, y",5,6,7,8,9\n1\n')
    (tmp_path / "b.csv").write_text("id\n1\n1,2\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("id,x\r\n1,2\r\n1\r\n")
    got = {r.source_file.rsplit("/", 1)[1]: tuple(r)[1:] for r in ragged_rows(spark, [str(tmp_path)]).collect()}
    assert got == {"a.csv": (8, 3, 2), "b.csv": (2, 0, 1), "d.csv": (2, 1, 0)}
