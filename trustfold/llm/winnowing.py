"""Document fingerprints by winnowing (Schleimer, Wilkerson, Aiken 2003).

All k-grams of characters get a rolling hash; every window of ``window``
consecutive k-grams chooses its smallest hash, the rightmost one in a tie;
chosen positions are kept.  Any common substring of at least
``window + k - 1`` characters then shares a chosen hash (match guarantee),
and its position in both texts is known.

Hashes are 40-bit, from a polynomial over code points modulo 2**64, so one
prefix sum gives all k-grams of a batch of texts.  A text shorter than k has
one gram, the whole text; a text with fewer grams than a window is one
window; an empty (or null) text has an empty fingerprint.

A fingerprint is printed as ``position:hash`` pairs (hexadecimal, positions
as distances from the pair before), joined by spaces: equal texts have equal
fingerprints.  Likeness is the Jaccard similarity of the chosen hashes (two
empty fingerprints are alike: 1).

``with_edits`` also fingerprints every text with its end replaced by the
beginning of the next document (descending id; after the last the first).
Rows are dealt by ranges of the id, so neighbours meet in one task, and each
range also gets the first row of the range after it.  A range streams
through its task; no group is held in memory.  Ties of the id are ordered by
text, null ids come last; repeated rows follow each other; one document is
its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import col
from trustfold.llm.textarrays import U64, mix, powers

#: Characters worked on at once (a longer text is a batch of its own, cut into overlapping tiles).
TILE = 1 << 19
HASH_BITS = 40
_POSITION = U64((1 << (64 - HASH_BITS)) - 1)


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """40-bit hashes of all k-grams of an array of code points."""
    n = len(points)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(points.astype(np.uint64) + U64(0x2545F491)) * powers(n), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * powers(n - k + 1, True)) >> U64(64 - HASH_BITS)


def _least(hashes: np.ndarray, w: int) -> np.ndarray:
    """For every window of w hashes the position of the smallest, the rightmost in a tie."""
    n = len(hashes)
    # smallest hash first, then the largest position: both in one number
    least = (hashes << U64(64 - HASH_BITS)) | (_POSITION - np.arange(n, dtype=np.uint64))
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[: n - w + 1], least[w - span : w - span + n - w + 1])
    return (_POSITION - (least & _POSITION)).astype(np.int64)


def _changes(at: np.ndarray) -> np.ndarray:
    """Without the repetitions of neighbouring windows."""
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def chosen(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions chosen by winnowing over the grams of one text (or tile)."""
    return _changes(_least(hashes, min(window, len(hashes))))


def winnow_one(points: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of one text; long texts in tiles that overlap by a window."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    k = min(k, len(points))
    if len(points) <= TILE:
        h = gram_hashes(points, k)
        at = chosen(h, window)
        return at, h[at]
    ats, hs, last = [], [], -1
    for lo in range(0, len(points) - k - window + 2, TILE):
        h = gram_hashes(points[lo : lo + TILE + window + k - 2], k)
        at = chosen(h, window)
        keep = at + lo > last
        ats.append(at[keep] + lo)
        hs.append(h[at[keep]])
        last = int(ats[-1][-1]) if len(ats[-1]) else last
    return np.concatenate(ats), np.concatenate(hs)


def winnow(texts: list[str], k: int, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) per text; texts that a window fits into are done together."""
    out: list = [None] * len(texts)
    together, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < k + window - 1 or len(t) > TILE:
            out[i] = winnow_one(_points(t), k, window)
            continue
        if together and size + len(t) > TILE:
            _together(texts, together, out, k, window)
            together, size = [], 0
        together.append(i)
        size += len(t)
    if together:
        _together(texts, together, out, k, window)
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _together(texts, which, out, k, window) -> None:
    points = _points("".join(texts[i] for i in which))
    bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in which])])
    hashes = gram_hashes(points, k)
    at = _least(hashes, window)
    for i, lo, hi in zip(which, bounds[:-1].tolist(), bounds[1:].tolist()):
        mine = _changes(at[lo : hi - k - window + 2])  # windows that lie in this text
        out[i] = mine - lo, hashes[mine]


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    a, b = np.unique(x), np.unique(y)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def printed(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    at, h = fingerprint
    steps = np.diff(at, prepend=0).tolist()
    return " ".join([f"{s:x}:{x:x}" for s, x in zip(steps, h.tolist())])


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", k: int = 24, window: int = 64) -> DataFrame:
    """Return per row: id, n_chars, positions and hashes (arrays) of the winnowed text."""
    docs = docs.select(col(id_column).alias(id_column), col(text_column).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = winnow(texts, k, window)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([f[0].tolist() for f in found], pa.list_(pa.int64())),
                     pa.array([f[1].astype(np.int64).tolist() for f in found], pa.list_(pa.int64()))], names=[id_column, "n_chars", "positions", "hashes"])

    longs = T.ArrayType(T.LongType())
    return docs.mapInArrow(run, T.StructType([docs.schema[0], T.StructField("n_chars", T.LongType()), T.StructField("positions", longs), T.StructField("hashes", longs)]))


def _edits(k: int, window: int):
    """Rows of one range in order -> results; each row's next is the row behind it in the range."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, waiting_print, waiting_carry = None, None, None  # (range, id, text) still without its next row
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                ranges, ids, carry = part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist()
                texts = [t or "" for t in part.column(3).to_pylist()]
                prints = winnow(texts, k, window)
                rows = []
                for i, r in enumerate(ranges):
                    if waiting is not None and waiting[0] == r and not waiting_carry:
                        rows.append((waiting[1], waiting[2], waiting_print, texts[i], prints[i]))
                    waiting, waiting_print, waiting_carry = (r, ids[i], texts[i]), prints[i], carry[i]
                if rows:
                    yield _results(rows, ids.type, k, window)

    return run


def _results(rows, id_type, k, window) -> pa.RecordBatch:
    edited = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for _, t, _, after, _ in rows]
    prints = winnow(edited, k, window)
    return pa.RecordBatch.from_arrays([
        pa.array([r[0].as_py() for r in rows], id_type),
        pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
        pa.array([printed(r[2]) for r in rows]), pa.array([printed(p) for p in prints]),
        pa.array([likeness(r[2][1], p[1]) for r, p in zip(rows, prints)], pa.float64()),
        pa.array([likeness(r[2][1], r[4][1]) for r in rows], pa.float64())],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def with_edits(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", k: int = 24, window: int = 64,
               ranges: int | None = None) -> DataFrame:
    """Return per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (integer ids)."""
    spark = docs.sparkSession
    docs = docs.select(col(id_column).cast("long").alias("id"), col(text_column).cast("string").alias("text"))
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(int(c) for c in docs.approxQuantile("id", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    # ranges count from the largest ids down; a null id comes after all others
    number = F.lit(len(cuts)) - F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda c: c <= F.col("id"))) if cuts else F.lit(0)
    placed = docs.withColumn("range", F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(number))
    used = [r["range"] for r in placed.select("id", "range").groupBy("range").count().orderBy("range").collect()]
    # the first row of each range also stands at the end of the range before it (the very first at the end of the last)
    before = {r: used[i - 1] for i, r in enumerate(used)}
    last = F.expr("case " + " ".join(f"when range = {r} then {b}" for r, b in before.items()) + " end") if used else F.lit(0)
    heads = placed.groupBy("range").agg(F.max("id").alias("head_id")).withColumnRenamed("range", "head_range")
    first = (placed.join(F.broadcast(heads),  # one row a range, at most two more than shuffle partitions
                         (F.col("range") == F.col("head_range")) & F.col("id").eqNullSafe(F.col("head_id")))
             .groupBy("range").agg(F.max("id").alias("id"), F.min(F.coalesce("text", F.lit(""))).alias("text")))
    rows = (placed.select("range", "id", F.lit(False).alias("carry"), "text")
            .union(first.select(last.alias("range"), "id", F.lit(True).alias("carry"), "text")))
    rows = rows.repartition(parts, "range").sortWithinPartitions(F.asc("range"), F.asc("carry"), F.desc_nulls_last("id"), F.coalesce("text", F.lit("")).asc())
    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_chars", T.LongType()),
                        *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
                        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
    return rows.mapInArrow(_edits(k, window), out).withColumnRenamed("id", id_column)
