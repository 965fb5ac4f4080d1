"""The rows of the pipeline's stages, each against a plain-Python result for its own input."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from test_decontaminate import words
from test_jaccard_join import expected, near_copies
from test_sharding import plain_shard

import corpus_pipeline
from trustfold.llm.sharding import Tree

STAGES = dict(corpus_pipeline.STAGES)


def without(text, phrases):
    """The words left when every phrase is cut out, again until none is left."""
    w = words(text)
    while True:
        hit = {k for p in phrases for at in range(len(w) - len(p) + 1) if w[at : at + len(p)] == p for k in range(at, at + len(p))}
        if not hit:
            return w
        w = [x for k, x in enumerate(w) if k not in hit]


def aims(sizes):
    """Target per source at weights 5, 2, 1, none above three times its size."""
    weight, out, left = dict(zip(sorted(sizes), (5, 2, 1))), {}, float(sum(sizes.values()))
    while rest := [s for s in sizes if s not in out]:
        unit = left / sum(weight[s] for s in rest)
        full = [s for s in rest if unit * weight[s] > 3 * sizes[s]]
        out |= {s: 3.0 * sizes[s] for s in full} if full else {s: unit * weight[s] for s in rest}
        left -= sum(3.0 * sizes[s] for s in full)
    return out


def test_rows_of_the_stages_match_plain_python(spark, tmp_path):
    rng = random.Random(8)
    items = [(i, " ".join(f"q{rng.randint(0, 300)}" for _ in range(rng.randint(10, 25)))) for i in range(8)]
    rows = [(i, t, rng.choice("abc")) for i, t in near_copies(5, 220)]
    for n, (i, t, s) in enumerate(rows):
        if n % 6 == 0:  # a passage of an item, of ten words or fewer than that
            own, some = t.split(), rng.choice(items)[1].split()
            at = rng.randint(0, len(own))
            rows[n] = (i, " ".join([*own[:at], *some[: rng.choice([9, 10, 25])], *own[at:]]), s)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(*r, len(r[1])) for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    given = lambda df: sorted(tuple(r) for r in df.collect())

    single = STAGES["near_duplicates"](spark, docs, str(tmp_path)).cache()
    keep = {d for d, n, least in expected([r[:2] for r in rows], 5, 80, 100) if not n or d == least}
    assert given(single) == sorted(r for r in rows if r[0] in keep) and 0 < len(keep) < len(rows)

    clean = STAGES["decontamination"](spark, single, str(tmp_path)).cache()
    phrases = [p[j : j + 10] for _, t in items for p in [words(t)] for j in range(len(p) - 9)]
    before, after = given(single), given(clean)
    assert [(i, s) for i, _, s, _ in after] == [(i, s) for i, _, s, _ in before] and all(n == len(t) for _, t, _, n in after)
    assert [words(t) for _, t, *_ in after] == [without(t, phrases) for _, t, *_ in before]
    same = [a == b for a, b in zip(before, after)]
    assert same == [without(t, phrases) == words(t) for _, t, *_ in before] and not all(same)

    mix = STAGES["mixing"](spark, clean, str(tmp_path)).cache()
    copies, size = Counter(given(mix)), {r: len(r[1].split()) for r in after}
    assert set(copies) <= set(after)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in after:
        sizes[r[2]] += size[r]
        taken[r[2]] += size[r] * copies[r]
    aim = aims(sizes)
    for s in sizes:
        assert abs(taken[s] - aim[s]) <= 1, s
    for r in after:
        least = int(aim[r[2]] // sizes[r[2]])
        assert not size[r] or least <= copies[r] <= min(3, least + 1), r

    shards = STAGES["sharding"](spark, mix, str(tmp_path))
    tree, got = Tree.even(2, 4, 5), shards.collect()
    place = {i: (plain_shard(i, tree), plain_shard(i, tree.grown())) for i, *_ in copies}
    assert (sorted((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got)
            == sorted((i, len(t.encode()) + 16, zlib.crc32(t.encode()), *place[i]) for i, t, *_ in copies.elements()))
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_stages_take_odd_rows_and_columns_of_any_name(spark, sf, odd, nothing):
    """Dotted, spaced and quoted names, nulls, repeated rows, no rows: every stage keeps the columns, none crashes."""
    for table in (odd, nothing):
        docs = table.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")})
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            rows = out.collect()
            if name != "sharding":
                assert out.columns == docs.columns, name
            if table is nothing:
                assert rows == [], name
            elif name == "toxicity":
                assert len(rows) == docs.count()
            elif name == "near_duplicates":
                assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows) == [(False, i) for i in (1, 2, 3, 4, 5, 6)] + [(True, None)]
