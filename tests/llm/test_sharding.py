"""Weighted hash tree: a plain-Python descent, slots, growth."""

import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from trustfold.llm.sharding import Tree, shard_of, sharded


def chain(values):
    h = 42
    for v in values:
        if isinstance(v, str):
            raw = v.encode()
        elif isinstance(v, tuple):
            raw = struct.pack("<i", v[0])
        else:
            raw = struct.pack("<q", v)
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return h


def plain_shard(key, tree):
    def draw(path, weights):
        return min((-math.log(((chain([key, *path, (c,)]) >> 11) + 0.5) * 2.0**-53) / w, c) for c, w in enumerate(weights))[1]

    i = draw(["region"], [sum(map(sum, r)) for r in tree.regions])
    j = draw(["rack", (i,)], [sum(r) for r in tree.regions[i]])
    c = draw(["shard", (i,), (j,)], tree.regions[i][j])
    return sum(len(r) for x in tree.regions[:i] for r in x) + sum(len(r) for r in tree.regions[i][:j]) + c


def test_descent_matches_plain_python(spark):
    tree = Tree((((1.0, 2.0), (3.0,)), ((0.5, 0.5, 4.0),))).grown(2.0)
    got = spark.range(300).select("id", shard_of(F.col("id"), tree).alias("s")).collect()
    assert [r["s"] for r in got] == [plain_shard(r["id"], tree) for r in got]


def test_rows_follow_weights_and_move_only_where_weights_rise(spark):
    tree = Tree.even(2, 2, 3)
    heavier = Tree((tree.regions[0], (tree.regions[1][0], (1.0, 1.0, 2.0))))  # rack 3, its last shard
    r = spark.range(20_000).select(shard_of(F.col("id"), tree).alias("a"), shard_of(F.col("id"), heavier).alias("b"),
                                   shard_of(F.col("id"), tree.grown()).alias("c")).collect()
    sizes = Counter(x["a"] for x in r)
    assert set(sizes) == set(range(12)) and all(abs(n - 20_000 / 12) < 200 for n in sizes.values())
    assert all(x["b"] >= 6 for x in r if x["a"] != x["b"])  # into the heavier region or within it
    assert {x["c"] for x in r if x["a"] != x["c"]} == {12}


@pytest.mark.parametrize("group", [100_000, 3])
def test_slots_sizes_and_checksums(docs, monkeypatch, group):
    monkeypatch.setattr("trustfold.llm.sharding.GROUP_ROWS", group)
    text = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    by = {}
    for r in sharded(docs, tree=Tree.even(2, 2, 2)).collect():
        assert r["size"] == len(text[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        assert r["grown_shard"] in (r["shard"], 8)
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == len(text)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_odd_rows(odd, nothing):
    got = sharded(odd).collect()
    assert len(got) == odd.count()
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] in (2, 3)} == {(16, 0)}
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharded(nothing).count() == 0


def test_no_python_in_the_plan(docs):
    plan = sharded(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
