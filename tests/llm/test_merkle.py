"""The Merkle manifest against a recursive model, over bands, arities and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from trustfold.llm.merkle import audited, folded, manifest, proof_digest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(d, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n_chars, text)))


def tree(leaves, arity=2):
    """Root and, per leaf, its (before, after) steps."""
    steps, level, above = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, members = [], []
        for at in range(0, len(level), arity):
            run = level[at : at + arity]
            for i in range(len(run)):
                for leaf_ in above[at + i]:
                    steps[leaf_].append(("".join(run[:i]), "".join(run[i + 1 :])))
            up.append(h(*run))
            members.append(sum(above[at : at + arity], []))
        level, above = up, members
    return level[0], steps


def expected(rows, arity=2):
    """Rows (doc_id, source, lang, n_chars, text): sorted tuples of the query's columns."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, out = {}, []
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        subs[g] = tree([leaf(*r) for r in groups[g]], arity)
    root, tops = tree([subs[g][0] for g in names], arity)
    for g, top in zip(names, tops):
        for r, own in zip(groups[g], subs[g][1]):
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            at = leaf(*r[:3], r[3] + 1, r[4]) if touched else leaf(*r)
            for before, after in own + top:
                at = h(before, at, after)
            out.append((r[0], leaf(*r), subs[g][0], root, h(*(a + b for a, b in own + top)), at, at == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def some_rows(n, seed=13):
    rng = random.Random(seed)
    return [(rng.choice([i, i, i, i // 2, None]), rng.choice(["a", None, "ü"]), rng.choice(["en", "en", "en", "de", "é", "", None, "Z"]), rng.choice([i, None, 0]),
             rng.choice(["text %d" % i, "", None, "x:y-1", "ß\n"])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 300])
def test_query_matches_the_model(spark, n):
    rows = some_rows(n)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", proof string").repartition(3)
    assert sorted(map(tuple, audited(df).collect()), key=str) == expected(rows)


@pytest.mark.parametrize("band,arity", [(1, 2), (3, 2), (2, 3)])
def test_bands_and_arities(spark, band, arity):
    rows = some_rows(200, band)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit(""))
    leaves = spark.createDataFrame([(r[0], r[2], leaf(*r)) for r in rows], "doc_id long, lang string, leaf string")
    made = manifest(leaves, band=band, arity=arity)
    got = made.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("p"), folded(F.col("leaf"), F.col("proof")).alias("f"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(*r[:5], r[3]) for r in expected(rows, arity)], key=str)
    assert df.count() == 200


def test_single_groups_and_one_large_group(spark):
    rows = [(i, "s", "en" if i % 3 else f"l{i}", i, "t") for i in range(2500)]  # 834 groups of one, one of 1,666
    assert sorted(map(tuple, audited(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == expected(rows)


def test_odd_rows(odd, nothing):
    extra = lambda d: d.withColumns({"lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in extra(odd).collect()]
    assert sorted(map(tuple, audited(extra(odd)).collect()), key=str) == expected(rows)
    assert audited(extra(nothing)).count() == 0
