"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; the leaves of a group, in the order of their ids, are
hashed up to the group's subroot, and the subroots, in the order of their
groups, to the root.  Nodes are labelled (level, index), so a node's label
comes before its parent's, and two sweeps over the labels do all:

* *forward*: nodes are taken in label order from a priority queue; a node
  hashes the digests that its children sent to its label and sends its own
  digest to its parent's label;
* *reversed*: from the root down, a node sends each child the child's
  siblings followed by what it was sent itself: the proof of the child.  What
  reaches a leaf is its proof.

The queue is external: the sweeps go in bands of ``band`` levels.  Between two
bands the digests lie in a table and are dealt by the label of the node
that ends the next band (tree, index of that node); within a band a task
takes the at most arity**band digests of such a node through a heap.  So a
dataset of n leaves takes log(n) / band rounds (3 for 10**9), no task ever
holds more than arity**band digests, whatever the size of a group, and the
driver only learns the depth of the deepest tree.

Leaves are numbered without ordering a group in one task: rows are range
partitioned by (group, id, digest) and written; positions are the running
row numbers less the offsets of the few (partition, group) counts.

Cases: nulls come first in the order of ids and of groups and make a group
of their own; rows with equal ids are ordered by digest (equal digests are
interchangeable); a group of one row has its leaf as subroot and a dataset
of one group its subroot as root; a node without sibling is hashed alone;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import col, fresh, stored

_STEP = T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
_STEPS = T.ArrayType(_STEP)
_ARROW_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def field(value: Column) -> Column:
    """A value inside a leaf: ``-`` if null, else the number of its UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def forward(digests: dict[int, str], levels: int, arity: int) -> dict[tuple[int, int], str]:
    """Digests of all nodes by label, from those of level 0 (by index), ``levels`` levels up."""
    queue = [(0, index, 0, digest) for index, digest in digests.items()]
    heapq.heapify(queue)
    known = {}
    while queue:
        level, index = queue[0][:2]
        sent = []
        while queue and queue[0][:2] == (level, index):
            sent.append(heapq.heappop(queue)[3])
        digest = _hash(sent) if level else sent[0]
        known[level, index] = digest
        if level < levels:
            heapq.heappush(queue, (level + 1, index // arity, index % arity, digest))
    return known


def backward(known: dict[tuple[int, int], str], top: tuple[int, int], suffix: tuple, arity: int) -> dict[int, tuple]:
    """Proofs of the nodes of level 0, by index: (siblings before, siblings after) a level, from the node up, then ``suffix``."""
    queue = [(-top[0], top[1], suffix)]
    out = {}
    while queue:
        level, index, proof = heapq.heappop(queue)
        if not level:
            out[index] = proof
            continue
        below = -level - 1
        children = [c for c in range(index * arity, (index + 1) * arity) if (below, c) in known]
        for i, c in enumerate(children):
            step = ("".join(known[below, s] for s in children[:i]), "".join(known[below, s] for s in children[i + 1 :]))
            heapq.heappush(queue, (-below, c, (step, *proof)))
    return out


def _up(band: int, arity: int, level: int):
    """The node that ends a band, from the digests below it (columns tree, depth, pos, digest)."""

    def run(table: pa.Table) -> pa.Table:
        levels = min(band, table["depth"][0].as_py() - level)
        known = forward(dict(zip(table["pos"].to_pylist(), table["digest"].to_pylist())), levels, arity)
        top = table["pos"][0].as_py() // arity**levels
        return pa.table({"tree": table["tree"].slice(0, 1), "depth": table["depth"].slice(0, 1), "pos": pa.array([top], pa.int64()),
                         "digest": pa.array([known[levels, top]])})

    return run


def _down(band: int, arity: int, level: int):
    """Proofs of the nodes of a band's lowest level, from theirs and the one of the node that ends the band."""

    def run(nodes: pa.Table, ends: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (*zip(nodes.schema.names, nodes.schema.types), ("proof", _ARROW_STEPS))})
        levels = min(band, nodes["depth"][0].as_py() - level)
        places = nodes["pos"].to_pylist()
        known = forward(dict(zip(places, nodes["digest"].to_pylist())), levels, arity)
        suffix = tuple((s["before"], s["after"]) for s in ends["proof"][0].as_py())
        proofs = backward(known, (levels, places[0] // arity**levels), suffix, arity)
        steps = pa.array([[{"before": a, "after": b} for a, b in proofs[p]] for p in places], _ARROW_STEPS)
        return nodes.append_column("proof", steps)

    return run


def _placed(rows: DataFrame, tree: Column, order: list[Column], arity: int) -> DataFrame:
    """``rows`` stored with tree, pos (in the tree) and depth (levels above the leaves of the tree)."""
    keyed = rows.withColumn("tree", tree)
    ranked = keyed.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranked = stored(ranked.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "leaves")
    counts = ranked.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    # one row per partition and tree: the windows run over partitions, not rows
    offsets = counts.select("part", "tree", (F.expr("sum(c) over (partition by tree order by part) - c") - F.col("first")).alias("shift"),
                            F.expr("sum(c) over (partition by tree)").alias("size"))
    depth, most = F.lit(0), 1
    while most < 2**62:
        depth = depth + (F.col("size") > most).cast("int")
        most *= arity
    return ranked.join(offsets, ["part", "tree"]).withColumns({"pos": F.col("at") + F.col("shift"), "depth": depth}).drop("part", "at", "shift", "size")


def _block(level: int, band: int, arity: int) -> Column:
    """The index of the node that ends the band of a node of ``level`` (trees may end within the band)."""
    least = F.least(F.lit(band), F.col("depth") - level)
    return F.expr("pos").cast("long") if band == 0 else F.floor(F.col("pos") / F.pow(F.lit(float(arity)), least)).cast("long")


def _forest(rows: DataFrame, band: int, arity: int, above) -> DataFrame:
    """``rows`` (tree, pos, depth, digest, ...) with proof, subroot and what ``above`` gives each tree.

    ``above`` maps the table (tree, subroot) to (tree, subroot, root, proof of the subroot).
    """
    deepest = rows.agg(F.max("depth")).first()[0]
    if deepest is None:
        deepest = 0
    layers, roots = [rows], []
    level, nodes = 0, rows.select("tree", "depth", "pos", "digest")
    schema = nodes.schema
    while True:
        roots.append(nodes.filter(F.col("depth") <= level).select("tree", F.col("digest").alias("subroot")))
        if level >= deepest:
            break
        open_ = nodes.filter(F.col("depth") > level).withColumn("block", _block(level, band, arity))
        nodes = stored(open_.groupBy("tree", "block").applyInArrow(_up(band, arity, level), schema), "nodes")
        level += band
        layers.append(nodes)
    finished = roots[0]
    for r in roots[1:]:
        finished = finished.union(r)
    tops = stored(above(finished), "subroots")

    # the reversed sweep: ends (tree, block, proof) of a band give the proofs of the level below it
    proofs = None
    for i in range(len(layers) - 1, -1, -1):
        level = i * band
        layer = layers[i]
        ended = layer.filter(F.col("depth") <= level).join(tops.select("tree", "proof"), "tree")
        if i == len(layers) - 1:
            proofs = ended
        else:
            lower = layer.filter(F.col("depth") > level).withColumn("block", _block(level, band, arity))
            ends = proofs.select("tree", F.col("pos").alias("block"), "proof")
            told = lower.groupBy("tree", "block").cogroup(ends.groupBy("tree", "block")).applyInArrow(
                _down(band, arity, level), T.StructType([*lower.schema.fields, T.StructField("proof", _STEPS)]))
            proofs = told.drop("block").unionByName(ended)
        if i:
            proofs = stored(proofs.select("tree", "pos", "proof"), "proofs")
    return proofs.join(tops.select("tree", "subroot", "root"), "tree")


def manifest(rows: DataFrame, *, digest: str = "leaf", id_column: str = "doc_id", group_column: str = "lang", band: int = 10, arity: int = 2) -> DataFrame:
    """``rows`` (one leaf each, with its digest) with subroot, root and proof.

    ``proof`` is an array of (before, after), from the leaf up to the root: the
    hex digests of the siblings before and after the node of that level,
    joined; both are empty where the node has no sibling.
    """
    names = [fresh(rows, n) for n in ("subroot", "root", "proof")]
    if names != ["subroot", "root", "proof"]:
        raise ValueError("the rows have columns named like the result's: subroot, root or proof")
    inner = rows.select(F.struct(*(col(c) for c in rows.columns)).alias("row"), col(digest).alias("digest"), col(id_column).alias("id"), col(group_column).alias("group"))
    inner = stored(inner, "digests")  # the texts are hashed once; the range partitioning samples this table
    # the key of a tree sorts as its group does, null first ('-' < '=')
    key = F.when(F.col("group").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("group").cast("string")))
    leaves = _placed(inner, key, [F.col("id").asc_nulls_first(), F.col("digest")], arity)

    def whole(roots: DataFrame) -> DataFrame:
        """The tree of the subroots."""
        subroots = _placed(roots.select(F.col("tree").alias("group"), F.col("subroot").alias("digest")), F.lit("all"), [F.col("group")], arity)

        def end(top: DataFrame) -> DataFrame:
            return top.select("tree", "subroot", F.col("subroot").alias("root"), F.array().cast(_STEPS).alias("proof"))

        done = _forest(subroots, band, arity, end)
        return done.select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "root", "proof")

    out = _forest(leaves, band, arity, whole)
    return out.select(*(F.col("row").getField(c).alias(c) for c in rows.columns), "subroot", "root", "proof")


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def audited(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, each proof tried on a leaf that is tampered with where 7 divides the id's checksum."""
    plain = ["doc_id", "source", "lang", "n_chars", "text"]
    values = [col(c) for c in plain]
    touched = [col("n_chars") + 1 if c == "n_chars" else col(c) for c in plain]
    hit = F.crc32(col("doc_id").cast("string")) % 7 == 0
    rows = docs.select(col("doc_id"), col("lang"), leaf_of(values).alias("leaf"),
                       F.when(hit & col("n_chars").isNotNull(), leaf_of(touched)).alias("tampered"))
    made = manifest(rows).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return made.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
