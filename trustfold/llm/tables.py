"""Small DataFrame helpers of the operators: written tables, unclashing names, bitmaps, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.session import scratch_path, scratch_root


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: computed once, safe against lost executors."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder that all executors share (set here only where the cluster names none)."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def bitmap_of(ids: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits (a power of two) in which the low bits of every id are set.

    Its size is fixed by ``bits`` whatever the number of ids, so it can go to
    the driver and be broadcast.  It only ever lets too much through.
    """
    slot = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1  # Spark's bitmap functions count from 1
    rows = (ids.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect())
    out = np.zeros(max(bits // 8, 4096), np.uint8)
    for r in rows:
        at = (r["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["bitmap"]), np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, ids: np.ndarray, bits: int) -> np.ndarray:
    slot = ids.astype(np.int64) & np.int64(bits - 1)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows of ``counts`` from some value of ``column`` (positive counts) on, so that there are at most ``most``.

    The bound is found on a histogram of logarithmic steps, so nothing is sorted and no row goes to the driver.
    """
    step = F.floor(8 * F.log2(col(column))).cast("int")  # at most 8 * 63 steps
    sizes = {r["step"]: r["c"] for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("c")).collect()}
    least, room = max(sizes, default=0) + 1, most
    for s in sorted(sizes, reverse=True):
        room -= sizes[s]
        if room < 0:
            break
        least = s
    return counts.filter(step >= least)


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Components of the graph with ``edges`` (a, b): one row (node, root) per node that has an edge.

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond", 2014).  Every round is two grouped
    minima and joins over the edges; no adjacency list is ever gathered, and
    each round is checkpointed, so the plan does not grow and a lost executor
    costs at most a round.  The root is the smallest node of the component.
    No edges give no rows.
    """
    e = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(e)
    for _ in range(most_rounds):
        if before[0] == 0:
            break
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                               F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
                 .select("p.a", "p.b").filter("a <> b").distinct())
        e = checkpointed(small)
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())


def _state(e: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return (r[0], r[1])


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names are compared without case)."""
    have = {c.lower() for c in df.columns}
    name, i = stem, 0
    while name.lower() in have:
        i += 1
        name = f"{stem}_{i}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The columns of the ``documents`` table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*columns)
