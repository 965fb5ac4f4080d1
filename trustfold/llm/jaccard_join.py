"""N-gram Jaccard join by prefix filters under several global token orders.

Two documents link when the Jaccard similarity of their sets of word
shingles reaches a threshold.  Then, under *any* total order of the
shingles, the first ``n - ceil(t * n) + 1`` shingles of both sets share one.
Candidates must share such a prefix shingle under three orders:

1. order A, rarest first.  The shingles whose hash falls into a fixed lower
   part of the hash range come first, by document frequency, then the rest
   by hash.  The part is a little larger than a prefix, so only that part of
   the shingles is counted (over all documents) and shuffled.  Shingles of
   one document only cannot make a candidate; they fill prefixes and are
   dropped at once, and with them almost every document without a partner.
2. order B, ascending hash, and order C, descending hash, need no counting.

Documents with equal sets are one *node* from the start (64-bit digest of
the set), so exact copies never multiply anything.  The nodes that share a
prefix shingle under A are that shingle's *group*; shingles with the same
nodes (all those of one quoted passage, say) count as one group.  A pair
that may link lies in some group, but sending every whole set to every
group would copy the sets of near copies dozens of times, and taking
connected groups together would compare documents that share nothing with
each other.  So groups become *cells* by what costs fewer copies of sets
(``_cells``): connected groups are one cell if they have few nodes, or if
that is cheaper than a cell per group; else the small groups are cells of
their own and the larger ones are looked at again without them.  Every
group lies whole in some cell, so no pair is lost, and a chain of documents
each quoting the next costs in proportion to its length.

Cells go to tasks in blocks of at most ``block`` nodes (larger cells as pairs
of blocks), where the filters A, B and C are intersected before the exact
comparison of whole sets; a block gives back a spanning forest of its
links, at most one edge for each node.  The components of those edges are
the result.

Cases: null or wordless texts have the empty set, n_shingles 0 and link
with nothing.  A text of fewer words than the shingle length has one
shingle, all its words.  Equal ids with different texts stay separate rows;
repeated rows give repeated rows.  The component id is the smallest id in
the component (null if all its ids are null).  An empty table gives an
empty result.  Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import bitmap_of, checkpointed, col, connected_components, in_bitmap, stored
from trustfold.llm.textarrays import (SPACED, U64, Chunk, chunk_of, gram_hashes, list_array, mix, run_hash, signed,
                                      slices, words_of)


def shingle_sets(chunk: Chunk, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles (all its words if fewer)."""
    words = words_of(chunk, SPACED)
    grams, at = gram_hashes(words, k)
    bounds = np.searchsorted(at, words.bounds)
    out = []
    for i, n in enumerate(words.counts.tolist()):
        if n >= k:
            out.append(np.unique(grams[bounds[i] : bounds[i + 1]]))
        elif n:
            out.append(np.array([run_hash(words.hash[words.bounds[i] : words.bounds[i + 1]])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digests(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit digest of each set (0 for the empty set)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        sums = np.add.reduceat(mix(np.concatenate(sets) + U64(0x51ED270B)), np.concatenate([[0], np.cumsum(sizes[full])[:-1]]))
        out[full] = mix(sums + sizes[full].astype(np.uint64))
    return signed(out)


def prefix_length(n, num: int, den: int):
    return n - (num * n + den - 1) // den + 1


def _cut(num: int, den: int) -> np.uint64:
    """Hashes below this belong to the counted part: 1.9 times a prefix."""
    return U64(min(2**64 - 1, int(2**64 * 1.9 * (den - num) / den)))


def _nodes(column: str, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, column):
            sets = shingle_sets(chunk_of(b.column(1)), k)
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n, pa.array(digests(sets))], names=["id", "n", "node"])

    return run


def _prefix_pool(column: str, k: int, num: int, den: int):
    """Per new set of a task: its shingles of the counted part, or its whole prefix if that part is too small."""
    cut = _cut(num, den)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in slices(batches, column):
            sets = shingle_sets(chunk_of(b.column(0)), k)
            tokens, nodes, more = [], [], []
            for s, node in zip(sets, digests(sets).tolist()):
                if not len(s) or node in seen:
                    continue
                seen.add(node)
                p = prefix_length(len(s), num, den)
                inside = int(np.searchsorted(s, cut))
                take = s[: max(inside, p)]
                tokens.append(take)
                nodes.append(np.full(len(take), node, np.int64))
                more.append(np.full(len(take), p - inside, np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(tokens))), pa.array(np.concatenate(nodes)),
                                                  pa.array(np.concatenate(more))], names=["token", "node", "short"])

    return run


def _wanted_sets(column: str, k: int, wanted, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, seen = wanted.value, set()
        for b in slices(batches, column):
            sets = shingle_sets(chunk_of(b.column(0)), k)
            ids = digests(sets)
            keep = []
            for i in np.flatnonzero(in_bitmap(bitmap, ids, bits)).tolist():
                if len(sets[i]) and int(ids[i]) not in seen:
                    seen.add(int(ids[i]))
                    keep.append(i)
            if keep:
                kept = [sets[i] for i in keep]
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in kept])])
                yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), list_array(signed(np.concatenate(kept)), bounds)],
                                                 names=["node", "shingles"])

    return run


def overlaps(x: list[np.ndarray], y: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """Matrix of the sizes of the intersections of all sets of x with all of y, in slices of ``width`` tokens."""
    out = np.zeros((len(x), len(y)), np.float32)
    tx, ty = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(np.unique(tx), np.unique(ty), assume_unique=True)
    if not len(both):
        return out

    def placed(sets, tokens):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(both, tokens)
        ok = both[np.minimum(at, len(both) - 1)] == tokens
        row, at = row[ok], at[ok]
        order = np.argsort(at, kind="stable")
        return row[order], at[order]

    (rx, cx), (ry, cy) = placed(x, tx), placed(y, ty)
    for lo in range(0, len(both), width):
        (a, b), (c, d) = np.searchsorted(cx, [lo, lo + width]), np.searchsorted(cy, [lo, lo + width])
        mx, my = np.zeros((len(x), width), np.float32), np.zeros((len(y), width), np.float32)
        mx[rx[a:b], cx[a:b] - lo] = 1
        my[ry[c:d], cy[c:d] - lo] = 1
        out += mx @ my.T
    return out


def links_between(left: list[tuple], right: list[tuple] | None, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Links (positions) between the nodes of two blocks, or within one (right None).

    A node is (sorted shingles, prefix tokens under order A).  The prefix
    filters of the three orders are intersected before the sets are compared.
    """
    other = left if right is None else right

    def under(nodes):
        return ([np.asarray(p) for _, p in nodes], [s[: prefix_length(len(s), num, den)] for s, _ in nodes],
                [s[len(s) - prefix_length(len(s), num, den) :] for s, _ in nodes])

    if len(left) * len(other) <= 400:
        la, lb, lc = ([set(x.tolist()) for x in f] for f in under(left))
        ra, rb, rc = (la, lb, lc) if right is None else ([set(x.tolist()) for x in f] for f in under(right))
        whole: dict[tuple, set] = {}

        def full(side, i, nodes):
            if (side, i) not in whole:
                whole[side, i] = set(nodes[i][0].tolist())
            return whole[side, i]

        for i in range(len(left)):
            for j in range(i + 1 if right is None else 0, len(other)):
                m, n = len(left[i][0]), len(other[j][0])
                if den * min(m, n) < num * max(m, n) or la[i].isdisjoint(ra[j]) or lb[i].isdisjoint(rb[j]) or lc[i].isdisjoint(rc[j]):
                    continue
                c = len(full(0, i, left) & full(0 if right is None else 1, j, other))
                if den * c >= num * (m + n - c):
                    yield i, j
        return
    n, m = np.array([len(s) for s, _ in left]), np.array([len(s) for s, _ in other])
    maybe = den * np.minimum.outer(n, m) >= num * np.maximum.outer(n, m)
    if right is None:
        maybe &= np.tri(len(left), k=-1, dtype=bool).T
    for fx, fy in zip(under(left), under(other)):
        if not maybe.any():
            return
        maybe &= overlaps(fx, fy) > 0
    rows, cols = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    if not len(rows):
        return
    c = overlaps([left[i][0] for i in rows], [other[j][0] for j in cols]).astype(np.int64)
    hit = maybe[np.ix_(rows, cols)] & (den * c >= num * (n[rows][:, None] + m[cols][None, :] - c))
    for i, j in zip(*np.nonzero(hit)):
        yield int(rows[i]), int(cols[j])


def _verify(num: int, den: int):
    """Links within each cell block; input sorted by cell block, output a spanning forest of each."""

    def forest(key, nodes):
        bi, bj = key[2:]
        first = [x for x in nodes if x[1] == bi]
        second = None if bi == bj else [x for x in nodes if x[1] == bj]
        if not first or second == []:
            return
        every = first + (second or [])
        up = list(range(len(every)))

        def top(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        pairs = links_between([x[2:] for x in first], None if second is None else [x[2:] for x in second], num, den)
        for i, j in pairs:
            a, b = top(i), top(j if second is None else len(first) + j)
            if a != b:
                up[a] = b
                yield every[a][0], every[b][0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, out = None, {}, []
        for b in batches:
            cols = [b.column(i) for i in range(6)]
            keys = list(zip(*(c.to_pylist() for c in cols[:4])))
            ids, blks = cols[4].to_pylist(), cols[5].to_pylist()
            lists = []
            for i in (6, 7):
                c = b.column(i)
                lists.append((c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)))
            for r, k in enumerate(keys):
                if k != key:
                    if len(nodes) > 1:
                        out.extend(forest(key, list(nodes.values())))
                    key, nodes = k, {}
                (so, sv), (po, pv) = lists
                nodes[ids[r]] = (ids[r], blks[r], sv[so[r] : so[r + 1]].view(np.uint64).copy(), pv[po[r] : po[r + 1]].view(np.uint64).copy())
            if len(out) > 10000:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
                out = []
        if len(nodes) > 1:
            out.extend(forest(key, list(nodes.values())))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def links(texts: DataFrame, *, words: int, num: int, den: int, block: int = 256) -> DataFrame:
    """(node, root) of every node (digest of a set) that links with another; ``texts`` has the one column text."""
    spark = texts.sparkSession
    pool = texts.mapInArrow(_prefix_pool("text", words, num, den),
                            T.StructType([_long("token"), _long("node"), T.StructField("short", T.IntegerType())]))
    pool = pool.repartition("token").dropDuplicates(["token", "node"])
    shared = pool.withColumn("df", F.expr("count(1) over (partition by token)")).filter("df > 1")
    prefixes = (shared.groupBy("node").agg(F.min("short").alias("short"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("l"))
                .filter("short + size(l) > 0")
                .select("node", F.expr("slice(l, 1, least(short, 0) + size(l)).token").alias("prefix")))
    prefixes = stored(prefixes, "prefixes")
    cells = _cells(prefixes.select("node", F.explode("prefix").alias("token")), block)
    placed = cells.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = placed.withColumn("blk", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    wanted, bits = _filter(cells.select("node").distinct())
    sets = texts.mapInArrow(_wanted_sets("text", words, wanted, bits), T.StructType([_long("node"), T.StructField("shingles", T.ArrayType(T.LongType()))]))
    whole = sets.join(prefixes, "node")
    to_check = (whole.join(placed, "node")
                .withColumn("pair", F.explode(F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, blk) as bi, greatest(x, blk) as bj))")))
                .select("kind", "cell", "pair.bi", "pair.bj", "node", "blk", "shingles", "prefix"))
    found = (to_check.repartition("kind", "cell", "bi", "bj").sortWithinPartitions("kind", "cell", "bi", "bj")
             .mapInArrow(_verify(num, den), T.StructType([_long("a"), _long("b")])))
    return connected_components(found)


def _cells(member: DataFrame, block: int) -> DataFrame:
    """Stored (kind, cell, node, size): cells that hold every group of ``member`` (node, token) whole, none of one node.

    Copies of whole sets that a cell of n nodes costs: n for each of its
    blocks, ceil(n / block).
    """
    def copies(n: str):
        return F.col(n) * F.ceil(F.col(n) / block)

    groups = member.groupBy("token").agg(F.count(F.lit(1)).alias("g"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                         F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"), F.min("node").alias("least")).filter("g > 1")
    same = groups.groupBy("g", "x", "y", "least").agg(F.min("token").alias("token"))  # one token for each set of nodes
    member = stored(member.join(same.select("token", "g", "least"), "token"), "groups")
    cells, small, kind = None, 1, 0
    while True:
        roots = connected_components(member.select(F.col("node").alias("a"), F.col("least").alias("b")).distinct())
        cost = (member.filter("node = least").join(roots, "node").groupBy("root").agg(F.sum(copies("g")).alias("apart")))
        sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
        verdict = sizes.join(cost, "root").withColumn("whole", (F.col("size") <= block) | (copies("size") <= F.col("apart")))
        judged = stored(roots.join(verdict.select("root", "size", "whole"), "root"), "judged")
        found = judged.filter("whole").select(F.lit(kind).alias("kind"), F.col("root").alias("cell"), "node", "size")
        rest = member.join(judged.filter("not whole").select("node"), "node")
        small *= 4
        found = found.union(rest.filter(F.col("g") <= small).select(F.lit(kind + 1), "token", "node", "g"))
        cells = found if cells is None else cells.union(found)
        member, kind = stored(rest.filter(F.col("g") > small), "groups"), kind + 2
        if member.isEmpty():
            return stored(cells, "cells")


def _filter(nodes: DataFrame):
    """A broadcast bitmap of the nodes, and its bits: 16 a node, within fixed bounds."""
    bits = 1 << min(28, max(20, (16 * nodes.count()).bit_length()))
    return nodes.sparkSession.sparkContext.broadcast(bitmap_of(nodes, "node", bits)), bits


def _base(docs: DataFrame, words: int) -> DataFrame:
    """Stored (id, n, node) of documents with columns id and text."""
    return stored(docs.mapInArrow(_nodes("text", words), T.StructType([docs.schema["id"], _long("n"), _long("node")])), "nodes")


def jaccard_components(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", words: int = 4,
                       num: int = 85, den: int = 100, block: int = 256) -> DataFrame:
    """Return per row of ``docs``: id, n_shingles, component_id (links: den * |x and y| >= num * |x or y|)."""
    docs = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("text"))
    base = _base(docs, words)
    roots = links(docs.select("text"), words=words, num=num, den=den, block=block)
    classed = (base.join(roots.select("node", "root"), "node", "left")
               .select("id", "n", "node", F.coalesce("root", "node").alias("class")))
    least = classed.filter("n > 0").groupBy("class").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    return (classed.join(least, (classed["class"] == least["class"]) & (classed["n"] > 0), "left")
            .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id")))


def _tagged(at: int, column: str, k: int, wanted, bits: int, repeated: bool):
    """Rows whose node may have company (``repeated``, with their node behind them), or the others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        for b in slices(batches, column):
            ids = digests(shingle_sets(chunk_of(b.column(at)), k))
            mask = in_bitmap(bitmap, ids, bits) & (ids != 0)
            keep = pa.array(mask if repeated else ~mask)
            rows = b.filter(keep)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids[mask])], names=[*rows.schema.names, "node"]) if repeated else rows

    return run


def one_of_each(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", words: int = 5, num: int = 80,
                den: int = 100, block: int = 256) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (nulls last), then the smallest text.

    Rows without words stay.  Only texts that may have company are shuffled,
    one a task and set of shingles, so a large group of copies stays cheap.
    """
    plain = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("text"))
    base = _base(plain, words)
    roots = checkpointed(links(plain.select("text"), words=words, num=num, den=den, block=block))
    copies = base.filter("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("node")
    wanted, bits = _filter(copies.union(roots.select("node")).distinct())
    at = docs.columns.index(text_column)
    row = F.struct(*(F.col(f"_{i}") for i in range(len(docs.columns))))
    renamed = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))  # names of any kind: Arrow functions resolve them as text
    alone = renamed.mapInArrow(_tagged(at, f"_{at}", words, wanted, bits, False), renamed.schema).toDF(*docs.columns)
    rank = F.struct(F.col(f"_{docs.columns.index(id_column)}").isNull(), F.col(f"_{docs.columns.index(id_column)}"), F.col(f"_{at}"))
    company = renamed.mapInArrow(_tagged(at, f"_{at}", words, wanted, bits, True), T.StructType([*renamed.schema.fields, _long("node")]))
    best = (company.groupBy("node").agg(F.min_by(F.struct(rank.alias("rank"), row.alias("row")), rank).alias("x"))
            .join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("class"))
            .agg(F.min_by("x", F.col("x.rank")).alias("x")))
    kept = best.select(*(F.col("x.row").getField(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))
    return alone.union(kept)
