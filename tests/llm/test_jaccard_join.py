"""Components of the n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from trustfold.llm.jaccard_join import _cells, jaccard_components, links_between, one_of_each
from trustfold.llm.tables import connected_components


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def expected(rows, k, num, den):
    sets, up = [shingles(t, k) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted([(d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(rows)], key=str)


def near_copies(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.7:
            t = rng.choice(out).split()
            for _ in range(rng.choice([0, 1, 1, 2])):
                if t:
                    t[rng.randrange(len(t))] = rng.choice(words)
            out.append(" ".join(t))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))))
    return list(enumerate(out))


def test_components_match_all_pairs(spark):
    for seed, num, block in ((1, 85, 256), (2, 60, 8)):
        rows = near_copies(seed, 150)
        got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=2, num=num, den=100, block=block)
        assert sorted([tuple(r) for r in got.collect()], key=str) == expected(rows, 2, num, 100)


def test_one_large_group_of_near_copies_in_blocks(spark):
    """300 near copies of one text and 300 exact ones, in blocks of 16: whole result, and no pair rows anywhere."""
    base = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join(base[:j] + [f"x{i}"] + base[j + 1 :])) for i, j in ((i, i % 80) for i in range(300))]
    rows += [(1000 + i, " ".join(base)) for i in range(300)] + [(5000, "quite another text of few words")]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=2, num=90, den=100, block=16)
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected(rows, 2, 90, 100)


def test_odd_rows(odd, nothing):
    pairs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = jaccard_components(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected(pairs, 4, 85, 100)
    assert jaccard_components(nothing).count() == 0


def test_one_row_of_each_component_stays(spark, odd):
    rows = near_copies(5, 120) + [(None, "p q r s t u"), (3000, "p q r s t u")]
    df = spark.createDataFrame([(t, d, "e") for d, t in rows], "text string, doc_id long, node string")
    kept = one_of_each(df, words=2, num=70)
    assert kept.columns == df.columns
    classes = expected(rows, 2, 70, 100)
    with_words = {c for _, n, c in classes if n}
    without = sorted(d for d, n, _ in classes if not n)
    got = sorted(r["doc_id"] for r in kept.collect())
    assert got == sorted([*with_words, *without])
    assert sorted(r["doc_id"] or -1 for r in one_of_each(odd).collect()) == [-1, 1, 2, 3, 4, 5, 6]


def test_matrix_and_loop_agree():
    rng = np.random.default_rng(3)
    nodes = [np.unique(rng.integers(0, 40, rng.integers(1, 40)).astype(np.uint64)) for _ in range(40)]
    left = [(s, s) for s in nodes]
    brute = {(i, j) for i in range(40) for j in range(i + 1, 40)
             if 10 * len(np.intersect1d(nodes[i], nodes[j])) >= 6 * len(np.union1d(nodes[i], nodes[j]))}
    assert set(links_between(left, None, 6, 10)) == brute
    assert {(i, j + 15) for i, j in links_between(left[:15], left[15:35], 6, 10)} == {(i, j) for i, j in brute if i < 15 <= j < 35}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def copies_of_sets(cells, block):
    return sum(r["size"] for r in cells.selectExpr("ceil(size / %d) as size" % block).collect())


@pytest.mark.parametrize("quoted", [2, 3, 6])
def test_a_chain_of_quotes_costs_in_proportion(spark, quoted):
    """Document i holds passages i to i + quoted - 1, so all are connected but none are alike."""
    cost = {}
    for n in (400, 1600):
        rows = [(i, i + j) for i in range(n) for j in range(quoted)]
        member = spark.createDataFrame(rows, "node long, passage long").selectExpr("node", "explode(array(passage * 10, passage * 10 + 1)) as token")
        cells = _cells(member, 64)
        cost[n] = copies_of_sets(cells, 64)
        inside = {}
        for r in cells.collect():
            inside.setdefault((r["kind"], r["cell"]), set()).add(r["node"])
        groups = [set(range(max(0, p - quoted + 1), min(n - 1, p) + 1)) for p in range(n + quoted - 1)]
        assert all(any(g <= c for c in inside.values()) for g in groups[:: n // 40] if len(g) > 1)
    assert cost[1600] <= 4.5 * cost[400]


def test_a_chain_of_quotes_and_its_copies_link_as_all_pairs_do(spark):
    rng = random.Random(8)
    passages = [" ".join(f"p{rng.randrange(400)}" for _ in range(12)) for _ in range(140)]
    rows = [(i, passages[i] + " " + passages[i + 1]) for i in range(139)]
    rows += [(1000 + i, rows[i][1].rsplit(" ", 1)[0] + " changed") for i in range(0, 139, 7)]
    rows += [(2000 + i, " ".join(passages[:4]) + f" end{i}") for i in range(40)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=2, num=80, den=100, block=16)
    assert sorted([tuple(r) for r in got.collect()], key=str) == expected(rows, 2, 80, 100)


def test_dense_groups_stay_one_cell(spark):
    rows = [(n, t) for n in range(200) for t in range(30) if (n * 7 + t) % 11]
    cells = _cells(spark.createDataFrame(rows, "node long, token long"), 64).collect()
    assert len({(r["kind"], r["cell"]) for r in cells}) == 1 and len(cells) == 200
