"""Dated CSV batch drops: explicit paths, exact headers, reading by name.

A batch is named explicitly (a date, a folder), never discovered by listing
a whole bucket.  Every file is read as text only (no inference pass), and
matched to the contract by column *name*.

All files are read by one positional reader, whatever their layouts: a row
meets its file's layout number by a join on the file, and each contract
column is picked from the position it has in that layout, so files with
different column orders never shift values between columns.  The driver
knows the distinct layouts; file names stay in DataFrames.
"""

from __future__ import annotations

import csv
import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from trustfold.operators.contracts import column_positions
from trustfold.session import scratch_path

ORIGIN = "_source_file"


def batch_paths(root: str, batches: list[str], template: str = "{root}/{batch}") -> list[str]:
    """Paths of the named batches (e.g. ``{root}/clients_{batch}.csv``)."""
    return [template.format(root=root.rstrip("/"), batch=b.strip()) for b in batches if b.strip()]


def as_metadata_uri(uri: str) -> str:
    """A file URI in the spelling of ``_metadata.file_path`` (percent-encoded,
    ``file:/x`` rather than ``file:///x``)."""
    return re.sub(r"^file:///", "file:/", uri)


def literal_path(path: str) -> str:
    """A path as a reader takes it literally: Spark reads ``[ ] { } * ? \\``
    in a path as a pattern, so a name that holds them needs escapes."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _given(paths: list[str]) -> list[str]:
    return [literal_path(p) for p in dict.fromkeys(paths)]


#: Bytes of a file one task reads for its first line; a larger file is several tasks (Spark's own default).
_SPLIT = 128 << 20


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """First line of each file under ``paths`` (taken literally): source_file, line; an empty file has line NULL.

    Spark's own text reader opens the files, so every file system and codec
    it knows works, and a read error fails the run.  A task is one file, or
    one split of a large file: the first row of the split that begins the
    file is its first line, however long that line is.  No Python worker
    runs: one that stopped early would hold its memory until it is gone, and
    many files would be many of them.  The price is a pass over the lines as
    text.  A shuffle of the found lines keeps the result's files few however
    many were read.  The reader's split sizes belong to a session of its own;
    the caller's settings stay as they are.

    No scan returns an empty file, so those are found by counting: only if
    the reader's listing has more files than gave a line are names compared.
    """
    own = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):  # so a second split never fits
        own.conf.set(key, str(_SPLIT))
    files = own.read.text(_given(paths))
    in_split = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the lower 33 bits number a task's rows
    rows = files.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line"),
                        F.col("_metadata.file_block_start").alias("start"), in_split.alias("row"))
    first = rows.where("start = 0 and row = 0").select("source_file", "line")
    path = scratch_path(spark, "first_lines")
    tasks = 2 * max(1, spark.sparkContext.defaultParallelism)
    first.repartition(tasks).write.parquet(path)
    found = spark.read.schema(first.schema).parquet(path)
    listed = files._jdf.inputFiles()  # stays in the JVM, where Spark keeps its listing anyway
    n = found.count()
    if n > len(listed):
        raise ValueError("the given paths overlap: some file would be read twice")
    if n < len(listed):
        names = spark.createDataFrame(pa.table({"source_file": pa.array([as_metadata_uri(u) for u in listed], pa.string())}),
                                      StructType([StructField("source_file", StringType())]))
        empty = names.join(found.select("source_file"), "source_file", "left_anti")
        found = found.union(empty.withColumn("line", F.lit(None).cast("string")))
    return found


def split_header(line: str | None) -> list[str]:
    """Exact column names of a CSV header line (quotes removed, BOM stripped); none of an empty line."""
    line = (line or "").removeprefix("\ufeff")
    if not line:
        return []
    csv.field_size_limit(sys.maxsize)
    return next(csv.reader([line]))


def read_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Exact header of every file under ``paths``: source_file, header.

    Only *distinct* first lines come to the driver and are split there, one
    for each layout however many files share it.  Empty files have no first
    line: they come back with an empty header, so every contract column is
    reported missing instead of failing the run.
    """
    if not paths:
        return spark.createDataFrame([], "source_file string, header array<string>")
    first = first_lines(spark, paths)
    lines = [r["line"] for r in first.select("line").distinct().collect()]
    layouts = spark.createDataFrame(pa.table({"line": pa.array(lines, pa.string()), "header": pa.array([split_header(x) for x in lines], pa.list_(pa.string()))}),
                                    StructType([StructField("line", StringType()), StructField("header", ArrayType(StringType()))]))
    found = first.join(F.broadcast(layouts), "line", "left")  # one row a distinct first line
    return found.select("source_file", F.coalesce("header", F.array().cast("array<string>")).alias("header"))


#: Files whose names and layouts are sent to every executor (some 200 bytes each); more are joined by a shuffle.
MOST_SENT_FILES = 200_000


def read_by_layout(spark: SparkSession, paths: list[str], layouts: dict[int, list[str]], routed: DataFrame,
                   expected: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows of all files under ``paths`` that ``routed`` (source_file, layout) gives one of
    ``layouts`` (number -> exact header): the expected columns under their
    canonical names, in contract order, plus the file URI.

    Files with layout NULL give no row.  A file that ``routed`` does not know
    (one that arrived after the headers were read) fails the run.  The
    schema is positional (``_c0``, ``_c1`` ...), all text and no wider than the
    last position any layout needs, so neither inference nor Spark's own
    header renaming is involved; the header line of every file is skipped.
    Extra columns are dropped.
    """
    if not layouts:
        return empty_batch(spark, expected)
    places = {i: column_positions(header, expected) for i, header in layouts.items()}
    width = 1 + max(p for found in places.values() for p in found)
    schema = StructType([StructField(f"_c{i}", StringType(), True) for i in range(width)])
    rows = spark.read.csv(_given(paths), schema=schema, header=True, enforceSchema=True, mode="PERMISSIVE")
    rows = rows.select(*schema.names, F.col("_metadata.file_path").alias(ORIGIN))
    known = routed.select(F.col("source_file").alias(ORIGIN), F.col("layout").alias("__layout"), F.lit(True).alias("__known"))
    if known.count() <= MOST_SENT_FILES:
        known = F.broadcast(known)
    unknown = F.raise_error(F.concat(F.lit("this file came after the headers were read: "), F.col(ORIGIN)))
    kept = rows.join(known, ORIGIN, "left").where(F.when(F.col("__known").isNull(), unknown).otherwise(F.col("__layout").isNotNull()))

    def pick(at: int):
        by_place: dict[int, list[int]] = {}
        for i, found in places.items():
            by_place.setdefault(found[at], []).append(i)
        (last, _), *others = sorted(by_place.items(), key=lambda x: -len(x[1]))
        out = F.col(f"_c{last}")
        for place, numbers in others:
            out = F.when(F.col("__layout").isin(numbers), F.col(f"_c{place}")).otherwise(out)
        return out

    return kept.select(*(pick(i).alias(name) for i, name in enumerate(expected)), ORIGIN)


#: Ends a line so that the number of its fields can be read off (no text file holds it).
_LINE_END = "\u0001end\u0001"


def ragged_rows(spark: SparkSession, paths: list[str], heads: DataFrame | None = None) -> DataFrame:
    """Rows per file that have fewer or more fields than its header: source_file, n_rows, n_short, n_long.

    Reading pads the ones and cuts the others without a word; this report
    tells of them.  One scan of the lines: a mark is put behind each line, the
    line is read by Spark's own CSV rules, quotes included, and the place of
    the mark is the number of fields.  Blank lines are no rows, as for the
    reader; a file whose first line is blank, or that has none, has no header
    and is left out.
    """
    heads = read_headers(spark, paths) if heads is None else heads
    widths = heads.select("source_file", F.size("header").alias("width")).where("width > 0")
    most = widths.agg(F.max("width")).first()[0] or 0
    fields = StructType([StructField(f"_c{i}", StringType(), True) for i in range(most + 2)])
    lines = spark.read.text(_given(paths)).select(F.col("_metadata.file_path").alias("source_file"), F.col("value"))
    marked = lines.where(F.length(F.trim("value")) > 0).select("source_file", F.from_csv(F.concat("value", F.lit("," + _LINE_END)), fields.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")).alias("f"))
    place = F.array_position(F.array(*(F.col(f"f._c{i}") for i in range(most + 2))), _LINE_END)
    # 0: the mark lies beyond the widest header
    n = marked.select("source_file", F.when(place > 0, place - 1).otherwise(most + 2).alias("n"))
    met = n.join(F.broadcast(widths) if widths.count() <= MOST_SENT_FILES else widths, "source_file")
    return met.groupBy("source_file").agg((F.count(F.lit(1)) - 1).alias("n_rows"), F.count_if(F.col("n") < F.col("width")).alias("n_short"),
                                          F.count_if(F.col("n") > F.col("width")).alias("n_long"))


def empty_batch(spark: SparkSession, expected: list[str] | tuple[str, ...]) -> DataFrame:
    schema = StructType([StructField(c, StringType(), True) for c in [*expected, ORIGIN]])
    return spark.createDataFrame([], schema)
