"""Small text helpers shared by readers and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_name(name: str) -> str:
    """Comparison form of a column name: surrounding blanks removed, lower case."""
    return name.strip().lower()


def quoted(name: str) -> str:
    """A column name as Spark takes it exactly: dots, spaces and backticks belong to the name."""
    return "`" + name.replace("`", "``") + "`"


def row_digest(cols: list[str]) -> Column:
    """A 128-bit digest of the named columns, as a struct of two longs to group and compare rows by.

    NULL-safe: hash functions pass over NULLs, so each value is followed by
    whether it is one.  Rows of a table of 10**12 rows meet by accident with a
    probability of some 10**-15.
    """
    parts = [x for c in cols for x in (F.col(quoted(c)), F.col(quoted(c)).isNull())]
    return F.struct(F.xxhash64(F.lit(0), *parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def basename(path: str | Column) -> Column:
    """Last path segment of a file URI or path."""
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -1)


def parent_name(path: str | Column) -> Column:
    """Name of the folder that holds the file (e.g. ``batch=2026-08-03``)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -2)


def parent_path(path: str | Column) -> Column:
    """Full path of the folder that holds the file (``gs://b/x/batch=1`` for
    ``gs://b/x/batch=1/part-0.csv``): unlike the folder *name*, it tells two
    same-named folders under different roots apart."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(p, "/[^/]*$", "")


def record_json(cols: list[str]) -> Column:
    """Compact JSON of the named columns, keeping NULL fields as ``null``."""
    return F.to_json(F.struct(*[F.col(quoted(c)) for c in cols]), {"ignoreNullFields": "false"})
