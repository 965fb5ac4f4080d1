"""Targets, flow and selection of the mix."""

import random

from pyspark.sql import functions as F

from trustfold.llm.mixing import min_cost_flow, mixed, nearest_sum, taken_words, targets


def test_targets_fill_up_and_share_the_excess():
    got = targets({"b": 100, "a": 10, None: 50, "c": 40})  # a 5, b 2, c 1, null 5
    assert got["a"] == 30 and abs(sum(got.values()) - 200) < 1e-9
    assert abs(got["b"] / got["c"] - 2) < 1e-9 and got[None] <= 150
    assert abs(got[None] / got["c"] - 5) < 1e-9 or got[None] == 150
    assert targets({}) == {} and targets({"a": 0}) == {"a": 0}


def brute_cost(taken, size):
    cost = 0
    for r in range(3):
        part = min(size, max(0, taken - r * size))
        cost += part * (r * (r + 1) // 2)
    return cost


def test_flow_meets_quotas_at_least_cost():
    rng = random.Random(4)
    for _ in range(30):
        patterns = [(("a",), rng.randint(0, 4)), (("b",), rng.randint(0, 4)), (("a", "b"), rng.randint(0, 4))]
        quotas = {"a": rng.randint(0, 8), "b": rng.randint(0, 8)}
        got = min_cost_flow(patterns, quotas, 3)
        best = None
        for x in range(3 * patterns[0][1] + 1):
            for y in range(3 * patterns[1][1] + 1):
                for z in range(3 * patterns[2][1] + 1):
                    ra, rb = quotas["a"] - x, quotas["b"] - y
                    if ra < 0 or rb < 0 or z > ra + rb:
                        continue
                    score = (-(x + y + z), sum(brute_cost(t, s) for t, (_, s) in zip((x, y, z), patterns)))
                    best = min(best, score) if best else score
        assert (-sum(got), sum(brute_cost(t, s) for t, (_, s) in zip(got, patterns))) == best


def test_taken_words_come_near_targets_and_reruns_agree(spark, docs):
    first, again = (taken_words(docs.repartition(n)).orderBy("doc_id").collect() for n in (2, 5))
    assert first == again
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    sizes = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in docs.select("doc_id", "text").collect()}
    sums, goal = {}, {}
    for r in first:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] in {0, r["size"], 2 * r["size"], 3 * r["size"]}
        sums[source[r["doc_id"]]] = sums.get(source[r["doc_id"]], 0) + r["taken"]
        goal[source[r["doc_id"]]] = r["target"]
    for s in goal:  # ten documents a source: every choice of them was considered
        own = [sizes[d] for d in sizes if source[d] == s]
        reach = {0}
        for n in own:
            reach |= {x + n for x in reach}
        spare = goal[s] - goal[s] // sum(own) * sum(own)
        assert abs(sums[s] - goal[s]) <= min(abs(x - spare) for x in reach) + 1


def test_nearest_sum():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randint(0, 9) for _ in range(rng.randint(0, 7))]
        goal = rng.randint(0, 30)
        best = min(abs(goal - sum(s for i, s in enumerate(sizes) if b >> i & 1)) for b in range(1 << len(sizes)))
        assert abs(goal - sum(s for s, yes in zip(sizes, nearest_sum(sizes, goal)) if yes)) == best


def test_hot_source_and_documents_of_several_sources(spark):
    rows = [(i, "w " * (1 + i % 7), ["hot"] if i % 3 else ["hot", "b"] if i % 2 else ["c"]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    words = (mixed(df, max_repeats=3).withColumn("n", F.regexp_count("text", F.lit("w")))).groupBy("source").sum("n").collect()
    total = sum(r[1] for r in words)
    assert abs(total - sum(1 + i % 7 for i in range(600))) <= 7


def test_mixed_repeats_rows_as_often_as_taken(spark, docs):
    counts = {r["doc_id"]: r["n"] for r in mixed(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for r in taken_words(docs).collect():
        assert r["taken"] == r["size"] * counts.get(r["doc_id"], 0) or not r["size"]
    assert mixed(docs).columns == docs.columns


def test_odd_rows(odd, nothing):
    got = taken_words(odd)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() == odd.count()
    assert got.filter("size = 0 and taken > 0 or taken > 3 * size").count() == 0
    assert got.filter("source_size is null or target is null").count() == 0
    assert taken_words(nothing).count() == 0 and mixed(nothing).count() == 0
    assert mixed(odd).columns == odd.columns
