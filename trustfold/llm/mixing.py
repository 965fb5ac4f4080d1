"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns.

1. Spark measures every document (words) and sums sizes per *membership
   pattern*, the set of sources a document belongs to.  A source's size is
   the sum over the patterns that contain it.
2. Sources get targets: shares of the whole by weight, none above
   ``max_repeats`` times its size; what that cuts off is shared again by
   weight among the others.
3. A min-cost flow routes capacity from patterns to the targets of their
   sources.  The first copy of a pattern's words costs nothing, each further
   copy costs more than the one before (convex), so repetition is spread
   evenly and used last.  The network has one node per pattern and source;
   only these sums reach the driver (``MAX_PATTERNS`` bounds them, beyond it
   the call fails before any row is dropped).
4. A pattern that is to give T words takes all its documents T // size
   times, and once more those with the smallest seeded hash, up to the rest.
   The cut is found by sums over hash ranges (4096, then 4096 in the range
   that holds the cut, then single hashes), never by ordering a pattern's
   documents in one task.  Of the ``AROUND`` documents on either side
   of the cut those are taken whose sizes add up nearest to what is asked.

Selection depends on the seed and on a row's id and text only, so reruns
agree.  Cases: null or wordless texts have size 0 and nothing taken; a null
source is a source of its own, after all others; rows with equal id and
text are taken or left together; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustfold.llm.tables import col, fresh, stored

#: Patterns and sources are a mix's description, not its data; this bounds what reaches the driver.
MAX_PATTERNS = 20_000
WORD = r"[^\x20\x09-\x0D]+"
_BITS = 60
#: Documents on either side of a pattern's cut among which the best fitting choice is made.
AROUND = 12


def targets(sizes: dict[str | None, int], weights: Sequence[float] = (5, 2, 1), share: float = 1.0,
            max_repeats: int = 3, whole: int | None = None) -> dict[str | None, float]:
    """Target per source: by weight (repeating, sources by code point, null last), at most max_repeats times the size.

    They add up to ``share`` of ``whole`` (the sum of the sizes unless given: overlapping sources hold less), as far as the limits allow.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out, free = share * (sum(sizes.values()) if whole is None else whole), {}, list(order)
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > max_repeats * sizes[s]]
        if not full:
            out.update({s: unit * weight[s] for s in free})
            break
        for s in full:
            out[s] = float(max_repeats * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, max_repeats: int) -> list[int]:
    """Words to take from each pattern (members, size): most of the quotas met, at the least convex repetition cost.

    Successive shortest paths with potentials on source - pattern (one arc a
    repetition) - member - sink.
    """
    names = {s: i for i, s in enumerate(quotas)}
    n_p, sink = len(patterns), 1 + len(patterns) + len(names)
    graph: list[list[list]] = [[] for _ in range(sink + 1)]

    def arc(u, v, capacity, cost):
        graph[u].append([v, capacity, cost, len(graph[v])])
        graph[v].append([u, 0, -cost, len(graph[u]) - 1])

    for p, (members, size) in enumerate(patterns):
        if size:
            for r in range(max_repeats):
                arc(0, 1 + p, size, r * (r + 1) // 2)
            for s in members:
                arc(1 + p, 1 + n_p + names[s], max_repeats * size, 0)
    for s, i in names.items():
        arc(1 + n_p + i, sink, quotas[s], 0)
    potential = [0] * (sink + 1)
    while True:
        dist, via = [None] * (sink + 1), [None] * (sink + 1)
        dist[0], heap = 0, [(0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for k, (v, capacity, cost, _) in enumerate(graph[u]):
                if capacity > 0:
                    to = d + cost + potential[u] - potential[v]
                    if dist[v] is None or to < dist[v]:
                        dist[v], via[v] = to, (u, k)
                        heapq.heappush(heap, (to, v))
        if dist[sink] is None:
            break
        far = max(d for d in dist if d is not None)
        for v in range(sink + 1):
            potential[v] += far if dist[v] is None else dist[v]
        flow, v = None, sink
        while v:
            u, k = via[v]
            flow = graph[u][k][1] if flow is None else min(flow, graph[u][k][1])
            v = u
        v = sink
        while v:
            u, k = via[v]
            graph[u][k][1] -= flow
            graph[v][graph[u][k][3]][1] += flow
            v = u
    taken = [0] * n_p
    for v, capacity, cost, back in graph[0]:
        taken[v - 1] += graph[v][back][1]
    return taken


def nearest_sum(sizes: list[int], goal: int) -> list[bool]:
    """A choice of the sizes whose sum is nearest to ``goal`` (in steps of goal / 2**18 where that is above 1)."""
    unit = max(1, goal >> 18)
    small, aim = [s // unit for s in sizes], goal // unit
    mask, reach = (1 << (2 * aim + 2)) - 1, [1]
    for s in small:
        reach.append((reach[-1] | reach[-1] << s) & mask)
    at = next(x for d in range(aim + 2) for x in (aim - d, aim + d) if x >= 0 and reach[-1] >> x & 1)
    picked = [False] * len(sizes)
    for i in range(len(sizes) - 1, -1, -1):
        if not reach[i] >> at & 1:
            picked[i] = True
            at -= small[i]
    return picked


@dataclass
class Mix:
    """``plan``: per pattern key its full copies, the hash cut, hashes taken beyond it and left out before it; ``sources``: name -> (size, target)."""

    plan: DataFrame
    sources: dict[str | None, tuple[int, float]]
    rows: DataFrame


def _members(sources: str, kind) -> Column:
    """The sources of a row as a sorted array of distinct names (null included)."""
    one = col(sources)
    return F.array_sort(F.array_distinct(F.coalesce(one.cast("array<string>"), F.array(F.lit(None).cast("string"))))) \
        if kind == "array" else F.array(one.cast("string"))


def _row_columns(docs: DataFrame, id_column: str, text_column: str, source_column: str, seed: int) -> dict[str, Column]:
    kind = docs.schema[source_column].dataType.typeName()
    return {"members": _members(source_column, kind), "key": F.to_json(F.struct(_members(source_column, kind).alias("m"))),
            "size": F.coalesce(F.regexp_count(col(text_column).cast("string"), F.lit(WORD)), F.lit(0)).cast("long"),
            "hash": F.xxhash64(F.lit(seed), col(id_column), col(text_column)).bitwiseAND(F.lit((1 << _BITS) - 1))}


def mix(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.0, max_repeats: int = 3, seed: int = 17) -> Mix:
    """Plan the mix.  ``source_column`` is a string, or an array of strings for documents of several sources."""
    spark = docs.sparkSession
    c = _row_columns(docs, id_column, text_column, source_column, seed)
    rows = stored(docs.select(col(id_column).alias("id"), *(c[k].alias(k) for k in c)), "mix_rows")
    sums = rows.groupBy("key", "members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    sums = sorted(sums, key=lambda r: r["key"])
    sizes: dict[str | None, int] = {}
    for r in sums:
        for s in r["members"]:
            sizes[s] = sizes.get(s, 0) + r["size"]
    goal = targets(sizes, weights, share, max_repeats, sum(r["size"] for r in sums))
    taken = min_cost_flow([(tuple(r["members"]), r["size"]) for r in sums], {s: round(t) for s, t in goal.items()}, max_repeats)
    copies = [t // r["size"] if r["size"] else 0 for t, r in zip(taken, sums)]
    rest = {r["key"]: t - k * r["size"] for t, k, r in zip(taken, copies, sums)}

    def table(columns: dict) -> DataFrame:
        return F.broadcast(spark.createDataFrame(pa.table(columns)))

    # the cut: hashes below it are taken once more; narrowed by 12 bits at a time
    cut = {k: 0 for k in rest}
    gap = dict(rest)
    live = sorted(k for k in gap if gap[k] > 0)
    shift = _BITS
    for step in (12, 12, None):
        if not live:
            break
        here = rows.join(table({"key": live, "low": pa.array([cut[k] for k in live], pa.int64())}), "key")
        inside = here.filter(F.shiftright("hash", shift) == F.shiftright("low", shift))
        shift = shift - step if step else 0
        part = inside.groupBy("key", F.shiftright("hash", shift).alias("range")).agg(F.sum("size").alias("size"))
        run = part.withColumn("total", F.expr("sum(size) over (partition by key order by range)"))
        need = table({"key": live, "gap": pa.array([gap[k] for k in live], pa.int64())})
        first_over = (run.join(need, "key").filter("total > gap").groupBy("key").agg(F.min(F.struct("range", "total", "size")).alias("x")).collect())
        for r in first_over:
            cut[r["key"]] = r["x"]["range"] << shift
            gap[r["key"]] -= r["x"]["total"] - r["x"]["size"]
        live = sorted(r["key"] for r in first_over)
    # around the cut, the choice of documents whose sizes add up nearest to what is asked
    close: dict[str, list[int]] = {k: [] for k in rest}
    away: dict[str, list[int]] = {k: [] for k in rest}
    short = sorted(k for k in gap if gap[k] > 0)
    if short:
        state = table({"key": short, "cut": pa.array([cut[k] for k in short], pa.int64())})
        near = (rows.join(state, "key").filter("size > 0").groupBy("key", "hash", "cut").agg(F.sum("size").alias("size"))
                .withColumn("inside", F.col("hash") < F.col("cut")))
        near = (near.withColumn("place", F.expr("row_number() over (partition by key, inside order by abs(hash - cut), hash)"))
                .filter(F.col("place") <= AROUND).select("key", "hash", "size", "inside").collect())
        around: dict[str, list] = {k: [] for k in short}
        for r in sorted(near, key=lambda r: r["hash"]):
            around[r["key"]].append((r["hash"], r["size"], r["inside"]))
        for k, some in around.items():
            picked = nearest_sum([size for _, size, _ in some], gap[k] + sum(size for _, size, inside in some if inside))
            close[k] = [h for (h, _, inside), yes in zip(some, picked) if yes and not inside]
            away[k] = [h for (h, _, inside), yes in zip(some, picked) if inside and not yes]
    keys = [r["key"] for r in sums]
    plan = table({"key": pa.array(keys, pa.string()), "copies": pa.array(copies, pa.int64()),
                  "cut": pa.array([cut[k] if rest[k] else 0 for k in keys], pa.int64()),
                  "close": pa.array([close[k] for k in keys], pa.list_(pa.int64())),
                  "away": pa.array([away[k] for k in keys], pa.list_(pa.int64()))})
    return Mix(plan, {s: (sizes[s], goal[s]) for s in sizes}, rows)


def _copies(name: Callable[[str], str] = str) -> Column:
    """Copies of a row joined to its pattern's plan; ``name`` gives the names of the plan's columns there."""
    h, cut, close, away, copies = (F.col(name(x)) for x in ("hash", "cut", "close", "away", "copies"))
    once_more = ((h < cut) & ~F.array_contains(away, h)) | F.array_contains(close, h)
    return copies + once_more.cast("long")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Per row: id, size, source_size, target, taken, for documents of one source each."""
    m = mix(docs, **options)
    spark = docs.sparkSession
    keyed = [(s, *v) for s, v in m.sources.items()]
    sources = F.broadcast(spark.createDataFrame(pa.table({"source": pa.array([k[0] for k in keyed], pa.string()),
                                                          "source_size": pa.array([k[1] for k in keyed], pa.int64()),
                                                          "target": pa.array([k[2] for k in keyed], pa.float64())})))
    return (m.rows.join(m.plan, "key").withColumn("source", F.col("members")[0])
            .join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
            .select(F.col("id").alias(options.get("id_column", "doc_id")), "size", "source_size", "target",
                    (F.col("size") * _copies()).alias("taken")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: every row as often as it is taken, all columns kept, no text shuffled."""
    m = mix(docs, **options)
    c = _row_columns(docs, options.get("id_column", "doc_id"), options.get("text_column", "text"),
                     options.get("source_column", "source"), options.get("seed", 17))
    names = {x: fresh(docs, f"mix_{x}") for x in ("key", "hash", *m.plan.columns)}
    plan = m.plan.toDF(*(names[x] for x in m.plan.columns))
    out = docs.withColumns({names["key"]: c["key"], names["hash"]: c["hash"]}).join(plan, names["key"])
    times = _copies(names.get)
    return (out.filter(times > 0).withColumn(names["copies"], F.explode(F.sequence(F.lit(1), times)))
            .select(*(col(x) for x in docs.columns)))
