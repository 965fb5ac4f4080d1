"""Profiling reports over raw text batches and event tables.

All reports are DataFrames (nothing printed, nothing collected) and each
one is a single aggregate over its input: per-column statistics are built
as one wide ``agg`` and then turned into rows, never one job per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trustfold.functions.casting import is_blank, is_dirty, uncastable
from trustfold.functions.text import quoted, row_digest


# ------------------------------------------------------------ schema/headers

def headers_per_file(headers: DataFrame) -> DataFrame:
    """Each file's column count and exact header (spot a file with another layout)."""
    return headers.select("source_file", F.size("header").alias("n_columns"), "header")


def schema_rows(spark, schema: StructType) -> DataFrame:
    """The discovered schema of a table as rows (position, column, type)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


# --------------------------------------------------------------- counts

def rows_per_group(df: DataFrame, by: str | list[str]) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))


def frequencies(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row count per combination of ``cols``."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))



def top_values_per_column(df: DataFrame, cols: list[str], k: int = 20) -> DataFrame:
    """k most frequent values of each of ``cols`` that exists in ``df``
    (column, value, n_rows, rank).  One aggregate for all columns; the rank
    filter keeps at most k rows per column and task before any shuffle."""
    cols = [c for c in cols if c in df.columns]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(quoted(c)).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.*")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy("column_name").orderBy(F.desc("n_rows"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def daily_activity(events: DataFrame, *, day: str, key: str, ts: str) -> DataFrame:
    """Per day: events, distinct entities, first and last event time."""
    return events.groupBy(day).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct(key).alias("n_entities"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def ranges(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Min and max of measures per group."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(by).agg(*aggs)


# --------------------------------------------------------- quality checks

def nulls_and_blanks(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: NULL cells and blank-after-trim cells, in one pass."""
    cols = cols or [c for c in df.columns if not c.startswith("_")]
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count(F.when(F.col(quoted(c)).isNull(), 1)).alias(f"n{i}"))
        blank = is_blank(F.col(quoted(c)).cast("string")) if dict(df.dtypes)[c] == "string" else F.lit(False)
        aggs.append(F.count(F.when(blank, 1)).alias(f"b{i}"))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.col(f"n{i}").alias("n_null"), F.col(f"b{i}").alias("n_blank"))
        for i, c in enumerate(cols)
    ])).alias("r")).select("r.*")


def uncastable_values(df: DataFrame, types: dict, *, int_policy: str = "legacy",
                      examples: int = 5) -> DataFrame:
    """Per typed column: how many non-NULL values do not convert, and up to
    ``examples`` of them (the smallest distinct ones, so the sample is
    reproducible)."""
    cols = [c for c in types if c in df.columns]
    bad = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.when(uncastable(c, types[c], int_policy), F.col(c)).alias("value"))
        for c in cols
    ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull())
    per_value = bad.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = per_value.groupBy("column_name").agg(F.sum("n").cast("bigint").alias("n_uncastable"))
    w = Window.partitionBy("column_name").orderBy("value")
    sample = (
        per_value.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= examples)
        .groupBy("column_name").agg(F.sort_array(F.collect_list("value")).alias("examples"))
    )
    return totals.join(sample, "column_name", "left")


def numeric_summary(df: DataFrame, types: dict, *, int_policy: str = "legacy", digits: int = 6,
                    as_double: bool = False) -> DataFrame:
    """count, mean, stddev, min, max of the convertible values per column
    (mean/stddev rounded to ``digits``).  Values convert with the column's
    own type (as typing would), then widen to double; ``as_double`` converts
    everything straight to double instead."""
    from trustfold.functions.casting import cast_text

    rows = []
    for i, c in enumerate([c for c in types if c in df.columns]):
        v = cast_text(c, "double" if as_double else types[c], int_policy).cast("double")
        rows.append((i, c, v))
    aggs = []
    for i, c, v in rows:
        aggs += [F.count(v).alias(f"c{i}"), F.avg(v).alias(f"a{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n"),
                 F.round(F.col(f"a{i}"), digits).alias("mean"), F.round(F.col(f"s{i}"), digits).alias("stddev"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c, _ in rows
    ])).alias("r")).select("r.*")


def numeric_quantiles(df: DataFrame, types: dict, *, int_policy: str = "legacy",
                      probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact discrete quantiles per column: the smallest value that at least
    ``p`` of the values do not exceed (NULL for a column without values).

    No column is ever held in one task: values are counted, the distinct ones
    dealt out by range, and only one total per range and column tells in which
    range a rank lies; that range alone is numbered.
    """
    from trustfold.functions.casting import cast_text
    from trustfold.session import materialize

    cols = [c for c in types if c in df.columns]
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), cast_text(c, types[c], int_policy).cast("double").alias("value")) for c in cols
    ])).alias("r")).select("r.*").where("value IS NOT NULL")
    counts = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    dealt = materialize(counts.repartitionByRange("column_name", "value").withColumn("part", F.spark_partition_id()), "quantiles")
    ends = (dealt.groupBy("column_name", "part").agg(F.sum("n").alias("n"))
            .withColumn("last", F.expr("sum(n) over (partition by column_name order by part)"))
            .withColumn("total", F.expr("sum(n) over (partition by column_name)")))
    wanted = (ends.withColumn("p", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("prob")) for i, p in enumerate(probs)])))
              .withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("total") * F.col("p.prob"))))
              .where("rank > last - n and rank <= last")
              .select("column_name", "part", F.col("p.i").alias("i"), (F.col("rank") - F.col("last") + F.col("n")).alias("rank")))
    numbered = dealt.withColumn("seen", F.expr("sum(n) over (partition by column_name, part order by value)"))
    picked = (numbered.join(wanted, ["column_name", "part"]).where("seen >= rank")
              .groupBy("column_name", "i").agg(F.min("value").alias("value"))
              .groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct("i", "value"))).alias("q")))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column_name"))
    return names.join(picked, "column_name", "left").select("column_name", F.col("q.value").alias("quantiles"))


def dirty_flags(df: DataFrame, types: dict, *, int_policy: str = "legacy", as_double: bool = False) -> DataFrame:
    """Add ``dirty_<col>`` per typed column (NULL, blank or not convertible),
    ``is_dirty`` (any) and ``n_dirty`` (how many).  ``as_double`` checks
    every column as a double, like a profiler that does not know the types."""
    cols = [c for c in types if c in df.columns]
    flags = {f"dirty_{c}": is_dirty(c, "double" if as_double else types[c], int_policy) for c in cols}
    out = df.withColumns(flags)
    any_flag: Column = F.lit(False)
    n: Column = F.lit(0)
    for f in flags:
        any_flag = any_flag | F.col(f)
        n = n + F.col(f).cast("int")
    return out.withColumns({"is_dirty": any_flag, "n_dirty": n})


def dirty_summary(flagged: DataFrame, by: str, types: dict) -> DataFrame:
    """Per group: rows, dirty rows, rows with >1 dirty column, dirty count per column."""
    cols = [c for c in types if f"dirty_{c}" in flagged.columns]
    return flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("is_dirty"), 1)).alias("n_dirty_rows"),
        F.count(F.when(F.col("n_dirty") > 1, 1)).alias("n_multi_dirty"),
        *[F.count(F.when(F.col(f"dirty_{c}"), 1)).alias(f"dirty_{c}") for c in cols],
    )


# -------------------------------------------------------------- duplicates

def duplicate_keys(df: DataFrame, *, unit: str, key: str) -> DataFrame:
    """(unit, key, n_rows) for keys seen more than once in a unit."""
    return (
        df.groupBy(unit, key).agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def keys_across_units(df: DataFrame, *, unit: str, key: str) -> DataFrame:
    """(key, n_units) for keys present in more than one unit (later
    snapshots, not an error)."""
    return (
        df.select(key, unit).distinct()
        .groupBy(key).agg(F.count(F.lit(1)).alias("n_units"))
        .where(F.col("n_units") > 1)
    )


def duplicate_rows(df: DataFrame, *, unit: str, key: str) -> DataFrame:
    """The complete rows of keys duplicated within a unit (semi join)."""
    return df.join(duplicate_keys(df, unit=unit, key=key).select(unit, key), [unit, key], "left_semi")


def duplicate_kind(df: DataFrame, *, unit: str, key: str, cols: list[str] | None = None) -> DataFrame:
    """Per duplicated (unit, key): rows, distinct versions, and whether all
    copies are identical.  Versions are told by a 128-bit digest of the row
    that sees NULLs, so rows holding NULLs are counted too."""
    cols = cols or [c for c in df.columns if c not in (unit,)]
    rows = df.select(quoted(unit), quoted(key), row_digest(cols).alias("__digest"))
    # rows shrink to their digests before the shuffle, and equal ones are counted there
    versions = rows.groupBy(quoted(unit), quoted(key), "__digest").agg(F.count(F.lit(1)).alias("n"))
    return versions.groupBy(quoted(unit), quoted(key)).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_versions")).where(
        "n_rows > 1").withColumn("identical", F.col("n_versions") == 1)


def dirty_duplicates(flagged: DataFrame, *, unit: str, key: str) -> DataFrame:
    """Duplicated (unit, key) pairs that also have a dirty row."""
    return duplicate_rows(flagged, unit=unit, key=key).where(F.col("is_dirty")).select(unit, key).distinct()
