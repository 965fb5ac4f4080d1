"""The quarantine ledger: one row per failed rule, with the untouched record.

Envelope, in this order (fixed for every stage that writes to the ledger):

=================  =========  ========  ==========================================
column             type       nullable  meaning
=================  =========  ========  ==========================================
rejected_at        timestamp  no        run timestamp (one literal per run)
stage              string     no        stage that applied the rule
rule               string     no        rule that failed
severity           string     no        e.g. ``blocking``
source_file        string     yes       file URI the record came from
record_key         string     yes       entity key of the record (NULL for files)
run_id             string     no        run identifier
original_record    string     yes       JSON of the record as read (text values,
                                        NULLs kept, ``_`` lineage columns left out)
=================  =========  ========  ==========================================
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from trustfold.functions.text import quoted, record_json

LEDGER_SCHEMA = StructType(
    [
        StructField("rejected_at", TimestampType(), False),
        StructField("stage", StringType(), False),
        StructField("rule", StringType(), False),
        StructField("severity", StringType(), False),
        StructField("source_file", StringType(), True),
        StructField("record_key", StringType(), True),
        StructField("run_id", StringType(), False),
        StructField("original_record", StringType(), True),
    ]
)
LEDGER_COLUMNS = [f.name for f in LEDGER_SCHEMA.fields]
NOT_NULL_COLUMNS = [f.name for f in LEDGER_SCHEMA.fields if not f.nullable]

LINEAGE_PREFIX = "_"


@dataclass(frozen=True)
class Run:
    """Identity of one run: id, one timestamp for every row it writes, and the
    stage/severity strings it stamps on rejects."""

    run_id: str
    started_at: str = field(
        default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    )
    stage: str = "trusted"
    severity: str = "blocking"

    def timestamp(self) -> Column:
        return F.lit(self.started_at).cast("timestamp")


def payload_columns(df: DataFrame) -> list[str]:
    """Columns that belong to the record itself (lineage columns excluded)."""
    return [c for c in df.columns if not c.startswith(LINEAGE_PREFIX)]


def from_rows(df: DataFrame, rule: str | Column, run: Run, *, key: str,
              origin: str = "_source_file", record: Column | None = None) -> DataFrame:
    """Ledger rows for rejected records (one per input row).

    ``rule`` may be a literal or a column (one rule per row).  ``record``
    overrides the payload; by default it is the JSON of the non-lineage
    columns with NULLs written out.
    """
    payload = record if record is not None else record_json(payload_columns(df))
    rule_col = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(
        run.timestamp().alias("rejected_at"),
        F.lit(run.stage).alias("stage"),
        rule_col.cast("string").alias("rule"),
        F.lit(run.severity).alias("severity"),
        F.col(quoted(origin)).cast("string").alias("source_file"),
        F.col(quoted(key)).cast("string").alias("record_key"),
        F.lit(run.run_id).alias("run_id"),
        payload.alias("original_record"),
    )


def from_file_errors(errors: DataFrame, run: Run) -> DataFrame:
    """Ledger rows for rejected files.

    ``errors`` has one row per (file, failed rule): ``source_file``,
    ``rule``, ``header`` (the exact names as read).  The record is
    ``{"header": [...]}`` and the key is NULL: no data row was read.
    """
    return errors.select(
        run.timestamp().alias("rejected_at"),
        F.lit(run.stage).alias("stage"),
        F.col("rule").cast("string").alias("rule"),
        F.lit(run.severity).alias("severity"),
        F.col("source_file").cast("string").alias("source_file"),
        F.lit(None).cast("string").alias("record_key"),
        F.lit(run.run_id).alias("run_id"),
        F.to_json(F.struct(F.col("header").alias("header"))).alias("original_record"),
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_violations(ledger: DataFrame) -> DataFrame:
    """One row with, per NOT NULL column, the number of NULLs found; a
    publish step refuses the slice when any of them is above zero."""
    return ledger.select(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in NOT_NULL_COLUMNS]
    )
