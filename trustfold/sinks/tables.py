"""Idempotent, all-or-nothing publishing.

* ``replace_table`` / ``read_table``: full replace of a table.  Readers see the
  former table whole until the new one is committed, also when the re-run
  fails, and the new one whole from then on.
* ``publish_ledger`` / ``read_ledger``: the shared quarantine ledger, partitioned
  by (stage, run id).  Publishing a run replaces its slices in one commit;
  other stages and runs are kept, also those published at the same time.
  With ``run_id`` the run's rows become exactly the given ones: slices that an
  earlier attempt left and this one does not write go in the same commit,
  also when a corrected run rejects nothing.
* ``clear_run``: removes a run's slices (all stages, or the named ones).

A slice with NULLs in NOT NULL columns is refused, and the original record
is stored as VARIANT (``parse_json``: a record that is not valid JSON fails the
publish instead of landing as text).  Both checks run inside the write job,
so a bad row fails the job before anything is committed.

How commits work, and what they need from the store, is in ``commits``.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType

from trustfold.operators.quarantine import LEDGER_COLUMNS, LEDGER_SCHEMA, NOT_NULL_COLUMNS, null_violations
from trustfold.sinks.commits import Store
from trustfold.sources.batches import literal_path

LEDGER_PARTITIONS = ("stage", "run_id")
#: The one slice of a table.
_TABLE = ""


def replace_table(df: DataFrame, path: str, *, files: int | None = None,
                  partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """Replace the table at ``path`` by ``df``.  ``files`` caps the number of output
    files with a final repartition (upstream stages keep their parallelism);
    leave it unset for large outputs."""
    out = df.repartition(files) if files else df
    store = Store(df.sparkSession, path)
    base, attempt = store.current(), store.attempt()
    try:
        w = out.write.format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(store.at(attempt))
        store.commit(base, {_TABLE: attempt})
    except BaseException:
        store.abandon(attempt)
        raise
    return path


def read_table(spark: SparkSession, path: str, *, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The committed table at ``path``; the files it is read from are fixed when this is called."""
    store = Store(spark, path)
    live = store.current().slices
    if not live:
        raise FileNotFoundError(f"no table was published at {path}")
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(literal_path(store.at(live[_TABLE])))


def check_not_null(ledger: DataFrame) -> None:
    """Raise when a NOT NULL ledger column holds NULLs (one aggregate job)."""
    row = null_violations(ledger).first()
    bad = {k: v for k, v in row.asDict().items() if v}
    if bad:
        raise ValueError(f"ledger slice violates NOT NULL: {bad}")


def _guarded(c: str):
    """The column, or a failed task when a NOT NULL column holds a NULL."""
    if c not in NOT_NULL_COLUMNS:
        return F.col(c)
    return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"ledger slice violates NOT NULL: {c}"))) \
        .otherwise(F.col(c)).alias(c)


def _stage_and_run(name: str) -> tuple[str, str]:
    """(stage, run id) of a slice named ``stage=x/run_id=y``."""
    stage, run = (unquote(part.split("=", 1)[1]) for part in name.split("/"))
    return stage, run


def clear_run(spark: SparkSession, path: str, run_id: str, *, keep_stages: set[str] | frozenset[str] = frozenset()) -> int:
    """Remove a run's slices from the ledger (but for ``keep_stages``) in one commit; their number."""
    store = Store(spark, path)
    base = store.current()
    gone = [n for n in base.slices if _stage_and_run(n)[1] == run_id and _stage_and_run(n)[0] not in keep_stages]
    if gone:
        store.commit(base, {}, lambda name: name in gone)
    return len(gone)


def publish_ledger(ledger: DataFrame, path: str, *, run_id: str | None = None) -> str:
    """Validate and publish rejects into the shared ledger in one pass and one commit.

    The slices (stage, run) that the rows name are replaced; with ``run_id``
    all slices of that run are."""
    typed = ledger.select(
        *[F.parse_json("original_record").alias("original_record") if c == "original_record" else _guarded(c)
          for c in LEDGER_COLUMNS]
    )
    store = Store(ledger.sparkSession, path)
    base, attempt = store.current(), store.attempt()
    try:
        typed.write.partitionBy(*LEDGER_PARTITIONS).parquet(store.at(attempt))
        written = {name: f"{attempt}/{name}" for name in store.partitions(attempt, len(LEDGER_PARTITIONS))}
        store.commit(base, written, lambda name: run_id is not None and _stage_and_run(name)[1] == run_id)
    except BaseException:
        store.abandon(attempt)
        raise
    if not written:
        store.delete(attempt)
    return path


# The ledger as published: the original record stored as VARIANT.
PUBLISHED_LEDGER_SCHEMA = StructType([
    StructField(f.name, VariantType(), True) if f.name == "original_record" else f for f in LEDGER_SCHEMA.fields
])


def read_ledger(spark: SparkSession, path: str, *, run_id: str | None = None) -> DataFrame:
    """The committed ledger with its fixed schema, or one run's part of it (only that run's folders are opened).

    A ledger that has only seen clean runs has no slice (or no folder) yet: it reads as empty."""
    store = Store(spark, path)
    live = [folder for name, folder in store.current().slices.items() if run_id is None or _stage_and_run(name)[1] == run_id]
    if not live:
        return spark.createDataFrame([], PUBLISHED_LEDGER_SCHEMA)
    reader = spark.read.schema(PUBLISHED_LEDGER_SCHEMA).option("basePath", store.root)
    return reader.parquet(*(literal_path(store.root) + "/" + folder for folder in sorted(live))).select(*LEDGER_COLUMNS)
