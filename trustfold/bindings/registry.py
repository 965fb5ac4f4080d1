"""Registry of driver-facing queries: name -> (Spark builder, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None, covers: tuple[str, ...] = ()):
    """Register a query.  ``sql`` is DuckDB SQL over the driver's views, or
    None when the result is not expressible as one SQL statement."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(covers))
        return fn

    return deco
