"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

Every row descends the tree from the root.  At each node each child draws
``-ln(u) / weight`` with u from a hash of (document id, child) and the
smallest draw wins, so children get rows in proportion to their weights and
a child's draw depends on nothing but the row and that child.  If a weight
rises, rows only move into that child's subtree; subtrees whose weights did
not change keep their rows or give some to it, and never trade rows.

The law kept is ``key``: id and shard count decide.  ``Tree.grown`` adds a
shard as a region of its own, so exactly the rows that move move into it.

Slots number the rows of a shard from 0 without gaps.  A shard's rows are
never ordered in one task: rows are numbered within (shard, hash bucket)
groups, and the groups' offsets are running sums over the few group counts.

DataFrame functions only; texts are read for their size and checksum and are
never shuffled.  Cases: a null text counts as empty (size 16, checksum 0); a
null id hashes like a value of its own; rows with equal ids share the shard
and get slots of their own (among equal (id, size, checksum) rows the slots
are interchangeable); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustfold.llm.tables import col

#: Rows of a (shard, bucket) group that one task numbers, on average.
GROUP_ROWS = 100_000


@dataclass(frozen=True)
class Tree:
    """regions[i][j] lists the weights of the shards of rack j of region i; shards count from 0 in this order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> Tree:
        return cls(tuple(tuple((1.0,) * shards for _ in range(racks)) for _ in range(regions)))

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own: no other subtree changes its weight."""
        return Tree((*self.regions, ((weight,),)))


def _smallest_draw(key: Column, path: list[Column], weights: list[Column]) -> Column:
    """Index of the child with the smallest weighted draw; ``path`` names the node, children count from 0."""
    draws = []
    for child, weight in enumerate(weights):
        h = F.xxhash64(key, *path, F.lit(child))
        u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
        draws.append(F.struct((-F.log(u) / weight).alias("draw"), F.lit(child).alias("child")))
    return F.array_min(F.array(*draws))["child"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key: three weighted draws, one a level."""
    def at(values, index):
        return F.element_at(F.array(*(F.lit(v) for v in values)), index + 1)

    region_weights = [float(sum(map(sum, region))) for region in tree.regions]
    region = _smallest_draw(key, [F.lit("region")], [F.lit(w) for w in region_weights])
    racks, leaves = {}, {}
    number = 0
    first: dict[tuple[int, int], int] = {}
    for i, r in enumerate(tree.regions):
        racks[i] = _smallest_draw(key, [F.lit("rack"), F.lit(i)], [F.lit(float(sum(rack))) for rack in r])
        for j, rack in enumerate(r):
            first[i, j] = number
            leaves[i, j] = _smallest_draw(key, [F.lit("shard"), F.lit(i), F.lit(j)], [F.lit(w) for w in rack]) + F.lit(number)
            number += len(rack)

    def pick(cases: list[tuple[Column, Column]]) -> Column:
        out = cases[-1][1]
        for condition, value in reversed(cases[:-1]):
            out = F.when(condition, value).otherwise(out)
        return out

    return pick([(region == i, pick([(racks[i] == j, leaves[i, j]) for j in range(len(r))])) for i, r in enumerate(tree.regions)]).cast("int")


def sharded(docs: DataFrame, *, tree: Tree | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return per row: id, size (bytes + 16), text_crc32, law, shard, slot, grown_shard (the shard in the grown tree)."""
    tree = tree or Tree.even(2, 4, 5)
    text = F.coalesce(col(text_column).cast("string"), F.lit(""))
    ids = docs.select(col(id_column).alias("id"))
    rows = docs.select(col(id_column).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    buckets = 1 + ids.count() // (GROUP_ROWS * tree.shards)

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumns({"shard": shard_of(F.col("id"), tree), "bucket": F.pmod(F.xxhash64(F.lit("bucket"), "id"), F.lit(buckets)).cast("int")})

    offsets = (placed(ids).groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "bucket", F.expr("sum(n) over (partition by shard order by bucket) - n").alias("offset")))
    numbered = placed(rows).withColumn("slot", F.expr("row_number() over (partition by shard, bucket order by id, size, text_crc32)"))
    return (numbered.join(offsets, ["shard", "bucket"])
            .select(F.col("id").alias(id_column), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("slot") - 1).alias("slot"), shard_of(F.col("id"), tree.grown()).alias("grown_shard")))
