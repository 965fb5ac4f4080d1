"""Strict typing of text columns in one pass.

A NULL or unconvertible value in any typed column keeps the whole row out
of the trusted output and yields one reject per failing column (rule
``<prefix><column in lower case>``, record = the untyped original).  The
failing rules are computed once into an array, so the trusted rows and the
rejects are two filters over the same tagged rows instead of one scan per
typed column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustfold.functions.casting import cast_text

FAILED = "__failed_rules"


def failed_rules(types: dict, *, int_policy: str = "legacy", prefix: str = "not_numeric_",
                 present: list[str] | None = None) -> Column:
    """Array of the rules a row fails, in the order of ``types`` (empty if none)."""
    cols = [c for c in types if present is None or c in present]
    if not cols:
        return F.array().cast("array<string>")
    flags = [
        F.when(cast_text(c, types[c], int_policy).isNull(), F.lit(f"{prefix}{c.lower()}"))
        for c in cols
    ]
    return F.filter(F.array(*flags), lambda r: r.isNotNull())


def tag_failures(df: DataFrame, types: dict, *, int_policy: str = "legacy",
                 prefix: str = "not_numeric_") -> DataFrame:
    return df.withColumn(FAILED, failed_rules(types, int_policy=int_policy, prefix=prefix,
                                              present=df.columns))


def typed_projection(columns: list[str], types: dict, *, int_policy: str = "legacy") -> list[Column]:
    """Columns in their order, typed ones converted."""
    return [cast_text(c, types[c], int_policy).alias(c) if c in types else F.col(c) for c in columns]


def split_castable(df: DataFrame, types: dict, *, int_policy: str = "legacy",
                   prefix: str = "not_numeric_") -> tuple[DataFrame, DataFrame]:
    """(typed rows, failures) where failures = input columns + ``_rule``, one
    row per failing column (underscore: the rule is not part of the record,
    so ``quarantine.from_rows(failures, F.col("_rule"), ...)`` keeps it out
    of the payload)."""
    tagged = tag_failures(df, types, int_policy=int_policy, prefix=prefix)
    ok = tagged.where(F.size(FAILED) == 0).select(*typed_projection(df.columns, types, int_policy=int_policy))
    bad = tagged.where(F.size(FAILED) > 0).select(*df.columns, F.explode(FAILED).alias("_rule"))
    return ok, bad
