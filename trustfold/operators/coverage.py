"""Coverage: which active entities each source knows about.

Inputs are reduced to one row per entity (labelled base) or per
(entity, batch) before joining, so the joins never multiply rows beyond
(active days x batches) per entity, and the per-day figures are plain
counts over unique rows instead of several DISTINCT aggregates (each
DISTINCT would re-expand the rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_days(events: DataFrame, *, key: str, day: str) -> DataFrame:
    """Distinct (entity, day) pairs with activity."""
    return events.select(key, day).distinct()


def by_source(active: DataFrame, labelled: DataFrame, batches: DataFrame, *, key: str, day: str,
              label: str, positive: str = "Yes", negative: str = "No") -> DataFrame:
    """Per day: active entities known to the labelled base, with a positive
    label, with a negative label, present in any batch, and in neither."""
    base = labelled.groupBy(key).agg(
        F.max(F.col(label).isNotNull()).alias("in_base"),
        F.max(F.col(label) == positive).alias("is_pos"),
        F.max(F.col(label) == negative).alias("is_neg"),
    )
    members = batches.select(key).distinct().withColumn("in_batch", F.lit(True))
    j = active.join(base, key, "left").join(members, key, "left")
    in_base = F.coalesce("in_base", F.lit(False))
    in_batch = F.coalesce("in_batch", F.lit(False))
    return j.groupBy(day).agg(
        F.count(F.when(in_base, 1)).alias("in_base"),
        F.count(F.when(F.coalesce("is_pos", F.lit(False)), 1)).alias("label_positive"),
        F.count(F.when(F.coalesce("is_neg", F.lit(False)), 1)).alias("label_negative"),
        F.count(F.when(in_batch, 1)).alias("in_batches"),
        F.count(F.when(~in_base & ~in_batch, 1)).alias("in_neither"),
    )


def batch_by_day(active: DataFrame, batches: DataFrame, *, key: str, day: str, batch: str) -> DataFrame:
    """Per (batch, day): members of the batch active that day."""
    members = batches.select(key, batch).distinct()
    return members.join(active, key, "inner").groupBy(batch, day).agg(
        F.count(F.lit(1)).alias("active_members")
    )
