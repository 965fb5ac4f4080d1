"""Trust-stage queries: ``orders`` as dated CSV batches -> trusted + quarantine."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.bindings.order_batches import (
    BATCH_LAYOUTS,
    ORDER_CONTRACT,
    REJECTED_BATCHES,
    TEXT_COLUMNS,
    TRUST_CTES,
    order_text,
    write_batches,
)
from trustfold.bindings.registry import register
from trustfold.operators.quarantine import Run
from trustfold.plans.trusted import TrustedOutput, build_trusted, read_accepted, route_files
from trustfold.session import scratch_path, unsorted_writer
from trustfold.sources.batches import batch_paths

RUN = Run(run_id="run-2026-08-31", started_at="2026-08-31T06:00:00Z")
_staged: dict[tuple[str, str], list[str]] = {}
_lock = threading.Lock()


def batch_of(col: str = "_source_file"):
    """``1995`` from ``.../batch=1995/part-....csv`` (or from the folder URI)."""
    return F.regexp_extract(F.col(col), r"batch=([^/]+)", 1)


def staged_batches(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write the order batches once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _staged:
            root = scratch_path(spark, "order_batches")
            _staged[key] = write_batches(order_text(unsorted_writer(spark), sf_dir), root)
        return _staged[key]


def trusted_run(spark: SparkSession, sf_dir: str, run: Run = RUN,
                batches: list[str] | None = None) -> TrustedOutput:
    paths = staged_batches(spark, sf_dir)
    if batches is not None:
        paths = [p for p in paths if p.rsplit("batch=", 1)[1] in batches]
    return build_trusted(spark, paths, ORDER_CONTRACT, run, unit="folder")


def _typed_select_sql(src: str) -> str:
    return f"""SELECT batch, o_orderkey, TRY_CAST(o_custkey AS INTEGER) AS o_custkey,
       CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS o_orderstatus,
       TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority, batch_date
FROM {src}
WHERE TRY_CAST(o_custkey AS INTEGER) IS NOT NULL AND TRY_CAST(o_totalprice AS DOUBLE) IS NOT NULL"""


_PAYLOAD_SQL = "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in TEXT_COLUMNS) + "}) AS VARCHAR)"

# -------------------------------------------------------------- reading


def csv_name_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the accepted batches, named one by one, read by name (all text,
    contract order)."""
    staged = staged_batches(spark, sf_dir)
    root = staged[0].rsplit("/", 1)[0]
    paths = batch_paths(root, [p.rsplit("batch=", 1)[1] for p in staged], "{root}/batch={batch}")
    raw = read_accepted(spark, paths, route_files(spark, paths, ORDER_CONTRACT, unit="folder"), ORDER_CONTRACT)
    return raw.select(batch_of().alias("batch"), *TEXT_COLUMNS)


register("csv_name_matched", f"{TRUST_CTES}\nSELECT batch, {', '.join(TEXT_COLUMNS)} FROM accepted",
         covers=("SRC-1", "SRC-8", "PRJ-1", "VAL-3", "VAL-4", "SET-1", "Q-16"))(csv_name_matched)


def _header_errors_sql() -> str:
    rows = []
    for b in REJECTED_BATCHES:
        lay = BATCH_LAYOUTS[b]
        norm = [n.strip().lower() for n in lay]
        payload = json.dumps({"header": lay}, separators=(",", ":"))
        seen = []
        for n, orig in zip(norm, lay):
            if norm.count(n) > 1 and n not in seen:
                seen.append(n)
                rows.append((b, "repeated_header", orig.strip(), payload))
        for c in ORDER_CONTRACT.columns:
            if c not in norm:
                rows.append((b, "missing_column", c, payload))
    vals = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {vals}) t(batch, rule, column_name, original_record)"


def all_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in which no batch passes the header check: an empty trusted table
    with its columns, and the file-level rejects; the raw rows counted beside."""
    out = trusted_run(spark, sf_dir, batches=list(REJECTED_BATCHES))
    n = F.count(F.lit(1)).alias("n_rows")
    return (out.trusted.agg(F.lit("trusted").alias("part"), n).union(out.quarantine.agg(F.lit("quarantine"), n))
            .union(order_text(spark, sf_dir).agg(F.lit("raw"), n)))


register(
    "all_rejected",
    f"""{TRUST_CTES}
SELECT 'trusted' AS part, count(*) AS n_rows FROM accepted WHERE batch IN ({", ".join("'" + b + "'" for b in REJECTED_BATCHES)})
UNION ALL SELECT 'quarantine', count(*) FROM ({_header_errors_sql()}) h
UNION ALL SELECT 'raw', count(*) FROM raw""",
    covers=("VAL-6",),
)(all_rejected)


def header_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-level rejects: one row per rejected batch folder, header and rule
    (only the header check runs; no data row is read)."""
    file_errors = route_files(spark, staged_batches(spark, sf_dir), ORDER_CONTRACT, unit="folder").file_errors
    return file_errors.select(
        F.regexp_extract("source_file", r"batch=([^/]+)$", 1).alias("batch"), "rule",
        F.col("column").alias("column_name"),
        F.to_json(F.struct(F.col("header").alias("header"))).alias("original_record"),
    )


register("header_errors", _header_errors_sql(),
         covers=("SRC-2", "VAL-1", "VAL-2", "VAL-5", "SRC-6"))(header_errors)

# ------------------------------------------------------------ end to end


def trusted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trusted_run(spark, sf_dir).trusted
    return t.select(batch_of().alias("batch"), *ORDER_CONTRACT.columns, F.col("_run_id").alias("run_id"))


register(
    "trusted_silver",
    f"{TRUST_CTES}\nSELECT *, '{RUN.run_id}' AS run_id FROM ({_typed_select_sql('single')}) x",
    covers=("VAL-15", "VAL-8", "VAL-9", "VAL-10", "VAL-11", "VAL-13", "VAL-14", "PRJ-2", "FLT-3", "Q-18"),
)(trusted_silver)


_ROW_REJECTS_SQL = f"""
SELECT batch, 'conflicting_duplicate_key' AS rule, o_orderkey AS record_key, {_PAYLOAD_SQL} AS original_record FROM conflict
UNION ALL
SELECT batch, 'not_numeric_o_custkey', o_orderkey, {_PAYLOAD_SQL} FROM single WHERE TRY_CAST(o_custkey AS INTEGER) IS NULL
UNION ALL
SELECT batch, 'not_numeric_o_totalprice', o_orderkey, {_PAYLOAD_SQL} FROM single WHERE TRY_CAST(o_totalprice AS DOUBLE) IS NULL"""


def trusted_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reject of the run (file level and row level), timestamp and path
    projected out: batch, stage, rule, severity, key, run, record."""
    q = trusted_run(spark, sf_dir).quarantine
    return q.select(F.regexp_extract("source_file", r"batch=([^/]+)", 1).alias("batch"),
                    "stage", "rule", "severity", "record_key", "run_id", "original_record")


def _file_rejects_sql() -> str:
    return (f"SELECT batch, rule, NULL::VARCHAR AS record_key, original_record FROM ({_header_errors_sql()}) h")


register(
    "trusted_quarantine",
    f"""{TRUST_CTES}
SELECT batch, '{RUN.stage}' AS stage, rule, '{RUN.severity}' AS severity, record_key, '{RUN.run_id}' AS run_id,
       original_record
FROM ({_ROW_REJECTS_SQL}
      UNION ALL {_file_rejects_sql()}) r""",
    covers=("VAL-7", "VAL-12", "SET-2", "PRJ-6", "Q-17", "SNK-3"),
)(trusted_quarantine)


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row conservation per accepted batch:
    raw = trusted + distinct rejected records + collapsed copies."""
    from trustfold.operators.report import reconcile as reconcile_op

    out = trusted_run(spark, sf_dir)
    raw = out.raw.withColumn("batch", batch_of())
    return reconcile_op(
        raw=raw, tagged=out.tagged.withColumn("batch", batch_of()),
        trusted=out.trusted.withColumn("batch", batch_of()),
        rejects=out.quarantine.where(F.col("record_key").isNotNull())
        .withColumn("batch", F.regexp_extract("source_file", r"batch=([^/]+)", 1)),
        by="batch",
    )


register(
    "reconcile",
    f"""{TRUST_CTES},
rej AS ({_ROW_REJECTS_SQL}),
r AS (SELECT batch, count(*) AS raw_rows FROM accepted GROUP BY batch),
d AS (SELECT batch, count(*) AS distinct_rows FROM dist GROUP BY batch),
t AS (SELECT batch, count(*) AS trusted_rows FROM ({_typed_select_sql('single')}) x GROUP BY batch),
q AS (SELECT batch, count(DISTINCT original_record) AS rejected_records FROM rej GROUP BY batch)
SELECT r.batch, r.raw_rows, coalesce(t.trusted_rows, 0) AS trusted_rows,
       coalesce(q.rejected_records, 0) AS rejected_records, r.raw_rows - d.distinct_rows AS collapsed_copies,
       r.raw_rows - coalesce(t.trusted_rows, 0) - coalesce(q.rejected_records, 0) - (r.raw_rows - d.distinct_rows) AS balance
FROM r JOIN d USING (batch) LEFT JOIN t USING (batch) LEFT JOIN q USING (batch)""",
    covers=("VAL-16",),
)(reconcile)
