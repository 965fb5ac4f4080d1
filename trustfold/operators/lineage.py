"""Lineage columns and label mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfold.functions.text import basename, parent_name
from trustfold.operators.quarantine import Run

INGESTED_AT = "_ingested_at"
RUN_ID = "_run_id"


def stamp(df: DataFrame, run: Run) -> DataFrame:
    """Append the run timestamp and run id (one literal each: every row of
    the run carries the same instant, however many jobs read the frame)."""
    return df.withColumns({INGESTED_AT: run.timestamp(), RUN_ID: F.lit(run.run_id)})


def with_origin(df: DataFrame, name: str = "_source_file", level: str = "uri") -> DataFrame:
    """Add the file the row came from: full URI, file name, or folder name."""
    uri = F.col("_metadata.file_path")
    col = {"uri": uri, "file": basename(uri), "folder": parent_name(uri)}[level]
    return df.withColumn(name, col)


def map_label(df: DataFrame, column: str, positive: str = "Yes", negative: str = "No") -> DataFrame:
    """Yes/No text to 1/0 (int) in place; any other value becomes NULL."""
    c = F.col(column)
    return df.withColumn(
        column, F.when(c == positive, F.lit(1)).when(c == negative, F.lit(0)).cast("int")
    )
