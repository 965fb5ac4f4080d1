"""Deterministic duplicate resolution.

1. Identical records (every column, and the same batch unit) collapse to
   one.  They are the same record delivered twice, not a conflict.
2. After that, a key with more than one version inside one unit is a real
   conflict.  No version is picked (that would not be reproducible): all of
   them are rejected.  The same key in *different* units is a later
   snapshot and is kept.

The unit is the file (``unit="file"``) or the folder holding it
(``unit="folder"``, for batches written as several part files).

Plan: the collapse is an aggregate over all columns, so copies meeting in
one task shrink before the shuffle.  Versions per (unit, key) are counted
by a second, partially aggregated group-by (one small row per key), and
only the keys with more than one version are left joined back: conflicts
are few, so AQE broadcasts them from their measured size and the collapsed
rows are not shuffled again.  Where conflicts are many, a key with a third
of all rows streams through a join that AQE can split; it never sits in one
window buffer.  NULL keys of one unit count together (NULL-safe join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfold.functions.text import parent_path, quoted

UNITS = ("file", "folder")


def _unit_col(origin: str, unit: str):
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    return F.col(origin) if unit == "file" else parent_path(origin)


def numbered_files(files: DataFrame, column: str) -> DataFrame:
    """The distinct files of a listing (one row per file or more) with numbers in the order of their names: file, number.

    Numbered in one task: one short row per file, whatever the files hold.
    """
    return files.select(F.col(column).alias("__file")).distinct().select("__file", F.expr("row_number() over (order by __file)").alias("__number"))


def collapse_identical(df: DataFrame, *, origin: str = "_source_file", unit: str = "file", files: DataFrame | None = None) -> DataFrame:
    """One row per distinct record and unit; column order kept.

    With ``unit="folder"`` copies in different part files of one folder are
    identical too; the surviving row keeps the smallest file URI.  Files are
    compared by their number (``numbered_files``; of ``files`` if the listing
    is known, else of ``df``), so the minimum is one of numbers and the
    aggregate stays a hash aggregate; the names come back by a join.
    """
    if unit == "file":
        return df.dropDuplicates()
    names = numbered_files(df, origin) if files is None else files
    rest = [c for c in df.columns if c != origin]
    found = df.join(names, df[origin].eqNullSafe(names["__file"])).withColumn("__unit", _unit_col(origin, unit))
    least = found.groupBy("__unit", *(quoted(c) for c in rest)).agg(F.min("__number").alias("__number"))
    return least.join(names, "__number").select(*(F.col("__file" if c == origin else quoted(c)).alias(c) for c in df.columns))


def conflicting_keys(collapsed: DataFrame, *, key: str, origin: str = "_source_file", unit: str = "file",
                     name: str = "__versions") -> DataFrame:
    """(unit, key, versions) of the keys with more than one version in a unit; ``collapsed`` has one row per distinct record and unit."""
    d = collapsed.withColumn("__unit", _unit_col(origin, unit))
    return d.groupBy("__unit", F.col(quoted(key)).alias("__key")).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def count_versions(collapsed: DataFrame, *, key: str, origin: str = "_source_file", unit: str = "file",
                   name: str = "__versions", conflicts: DataFrame | None = None) -> DataFrame:
    """Add the number of versions of each row's key within its unit to rows
    that are already collapsed (one row per distinct record and unit).
    ``conflicts`` are their ``conflicting_keys``, where these are stored already."""
    counts = conflicting_keys(collapsed, key=key, origin=origin, unit=unit, name=name) if conflicts is None else conflicts
    l, r = collapsed.withColumn("__unit", _unit_col(origin, unit)).alias("l"), counts.alias("r")
    cond = F.col("l.__unit").eqNullSafe(F.col("r.__unit")) & F.col(f"l.{quoted(key)}").eqNullSafe(F.col("r.__key"))
    return l.join(r, cond, "left").select(*[F.col(f"l.{quoted(c)}") for c in collapsed.columns],
                                          F.coalesce(F.col(f"r.{name}"), F.lit(1).cast("bigint")).alias(name))


def tag_versions(df: DataFrame, *, key: str, origin: str = "_source_file", unit: str = "file",
                 name: str = "__versions") -> DataFrame:
    """Collapse identical rows and add the number of versions of each row's
    key within its unit."""
    return count_versions(collapse_identical(df, origin=origin, unit=unit), key=key, origin=origin, unit=unit,
                          name=name)


def split_conflicts(df: DataFrame, *, key: str, origin: str = "_source_file",
                    unit: str = "file") -> tuple[DataFrame, DataFrame]:
    """(kept, conflicting): both with the input's columns and order."""
    t = tag_versions(df, key=key, origin=origin, unit=unit)
    ok = t.where(F.col("__versions") == 1).select(*map(quoted, df.columns))
    bad = t.where(F.col("__versions") > 1).select(*map(quoted, df.columns))
    return ok, bad
