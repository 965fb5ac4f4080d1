"""Filter interactions by wide packed counters.

k filters fail each document or not: a mask of k bits.  Applied one after
the other in some order, every step keeps the document, removes it, or finds
it removed already (redundant, if the filter fails it too).  What happens at
each of the k! * k steps of all orders depends on the mask alone, so

* every mask is mapped once to one wide integer with a 64-bit field for
  each (outcome, order, step), holding 1 where that is the outcome;
* the integers of a part's documents are summed: a mask that n documents
  share adds n times its integer, and the removals of good and of toxic
  documents are the same integer, shifted to fields of their own;
* the sum is unpacked.  A field counts documents of the part at most once,
  and Spark's counts are below 2**63, so no field runs into the next.

Masks are computed in one pass over the texts, and equal (part, mask, marks)
rows are counted before the integers are summed, so a part of any size
reaches its task as at most 2**k * 4 rows.

Duplicates need no window over a group of equal texts: rows are counted by
(text digest, part, mask, marks, id), then each text's smallest id is taken
from those counts.

Cases: null texts count as empty, so they equal each other and empty ones; a
null source is the part ''; a row with a null id is never a duplicate and
makes none; repeated rows (equal ids) are no duplicates of each other; a
document with several label rows is good or toxic if any of them says so; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import col

KEPT, REMOVED, REDUNDANT, GOOD_LOST, TOXIC_LOST = range(5)
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


#: What filters C and D count, as bytes of UTF-8.
_CAPITALS, _SYMBOLS = bytes(range(65, 91)), b"#$%&*|"


def text_mask(text: str, raw: bytes) -> int:
    """The failures of filters A to D (bits 0 to 3); ``raw`` is the text in UTF-8."""
    words = raw.split()  # at ASCII white space: 0x20 and 0x09 to 0x0D
    n = len(words)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * capitals > 5 * len(text)) << 2
            | (len(raw.translate(None, _SYMBOLS)) < len(raw)) << 3)


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, part, digest of the text, mask); one text at a time is held beside its batch."""
    for b in batches:
        keys, masks = [], []
        for value in b.column(2):
            text = value.as_py() or ""
            raw = text.encode()
            keys.append(hashlib.sha256(raw).digest())
            masks.append(text_mask(text, raw))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(masks, pa.int32())],
                                         names=["id", "part", "text_key", "mask"])


def orders_of(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def packed(letters: str) -> list[int]:
    """For every mask (bit i: letter i fails) the wide integer of its outcomes kept, removed and redundant."""
    orders, k = orders_of(letters), len(letters)
    width, fields = 64, len(orders) * k
    out = []
    for mask in range(2**k):
        total = 0
        for o, order in enumerate(orders):
            gone = False
            for step, letter in enumerate(order):
                fails = mask >> letters.index(letter) & 1
                outcome = None if gone and not fails else REDUNDANT if gone else REMOVED if fails else KEPT
                if outcome is not None:
                    total |= 1 << width * (outcome * fields + o * k + step)
                gone = gone or bool(fails)
        out.append(total)
    return out


def removals(integer: int, letters: str) -> int:
    """The fields of the removals alone, as the lowest ones."""
    bits = 64 * len(orders_of(letters)) * len(letters)
    return integer >> bits & (1 << bits) - 1


def _unpacked(letters: str):
    orders, k = orders_of(letters), len(letters)
    fields = len(orders) * k
    table = packed(letters)
    lost = [removals(x, letters) for x in table]

    def run(part: pa.Table) -> pa.Table:
        total, alone = 0, dict.fromkeys(letters, 0)
        for mask, good, toxic, n in zip(*(part[c].to_pylist() for c in ("mask", "good", "toxic", "n"))):
            total += n * table[mask]
            if good:
                total += n * lost[mask] << 64 * fields * GOOD_LOST
            if toxic:
                total += n * lost[mask] << 64 * fields * TOXIC_LOST
            if mask & mask - 1 == 0 and mask:
                alone[letters[mask.bit_length() - 1]] += n
        counts = np.frombuffer(total.to_bytes(8 * fields * 5, "little"), "<u8").astype(np.int64).reshape(5, fields)
        steps = [letter for order in orders for letter in order]
        by_letter = dict.fromkeys(letters, 0)
        for letter, n in zip(steps, counts[REMOVED].tolist()):
            by_letter[letter] += n
        out = {"part": pa.array([part["part"][0].as_py()] * fields, pa.string()), "filter_order": pa.array(np.repeat(orders, k).tolist()),
               "step": pa.array(list(range(1, k + 1)) * len(orders), pa.int32()), "kept": counts[KEPT], "removed": counts[REMOVED],
               "redundant": counts[REDUNDANT], "unique_fails": [alone[s] for s in steps], "good_lost": counts[GOOD_LOST],
               "toxic_lost": counts[TOXIC_LOST], "shapley": [by_letter[s] for s in steps]}
        return pa.table(out)

    return run


def interactions(masks: DataFrame, letters: str) -> DataFrame:
    """All orders and steps per part, from rows (part, mask, good, toxic, n): n documents of that mask and these marks."""
    counts = masks.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in _COUNTS)])
    return counts.groupBy("part").applyInArrow(_unpacked(letters), schema)


def failure_masks(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n) of documents under the filters A to E (E: a copy of a smaller id's text)."""
    texts = docs.select(col(id_column).alias("id"), F.coalesce(col(part_column).cast("string"), F.lit("")).alias("part"),
                        col(text_column).cast("string").alias("text"))
    rows = texts.mapInArrow(_marked, T.StructType([texts.schema["id"], T.StructField("part", T.StringType()), T.StructField("text_key", T.BinaryType()),
                                                   T.StructField("mask", T.IntegerType())]))
    marks = (labels.filter(col(id_column).isNotNull()).groupBy(col(id_column).alias("id"))
             .agg(F.max(F.coalesce(col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(col("toxic") == 1, F.lit(False))).alias("toxic")))
    marked = rows.join(marks, "id", "left").fillna(False, ["good", "toxic"])
    kind = ["text_key", "part", "mask", "good", "toxic"]
    each = marked.groupBy("id", *kind).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("id").isNotNull()
    kinds = each.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum(F.when(known, 1).otherwise(0)).alias("ids"),
                                    F.min(F.when(known, F.struct("id", "n"))).alias("low"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("unnamed"))
    copied = kinds.groupBy("text_key").agg(F.min("low.id").alias("first"), F.sum("ids").alias("all_ids")).filter("all_ids > 1").select("text_key", "first")
    told = kinds.join(copied, "text_key", "left")
    own = F.when(F.col("first").isNull(), F.col("n")).otherwise(F.when(F.col("low.id") == F.col("first"), F.col("low.n")).otherwise(0) + F.col("unnamed"))
    split = told.withColumn("own", own).select("part", "mask", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), F.col("own").alias("n")),
        F.struct(F.lit(1).alias("copy"), (F.col("n") - F.col("own")).alias("n")))).alias("x")).filter("x.n > 0")
    return split.select("part", (F.col("mask") + F.col("x.copy") * 16).alias("mask"), "good", "toxic", F.col("x.n").alias("n"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts per part, order of the filters A to E and step."""
    return interactions(failure_masks(docs, labels), "ABCDE")
