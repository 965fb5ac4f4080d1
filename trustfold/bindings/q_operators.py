"""Single-operator queries: typing and labels on the order text derived in memory,
duplicate resolution on the lineitem text read back from its CSV folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.bindings.order_batches import ORDER_CONTRACT, RAW_TEXT_CTE, TEXT_COLUMNS, order_text
from trustfold.bindings.q_profile import LINE_COLUMNS, LINEITEM_TEXT_SQL, staged_lines
from trustfold.bindings.q_trusted import RUN
from trustfold.bindings.registry import register
from trustfold.operators.dedup import split_conflicts, tag_versions
from trustfold.operators.lineage import map_label, stamp, with_origin
from trustfold.operators.quarantine import from_rows
from trustfold.operators.strict_types import split_castable

_ORD = f"WITH {RAW_TEXT_CTE.strip()}\n"
_PAYLOAD = "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in TEXT_COLUMNS) + "}) AS VARCHAR)"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order text with the batch as a lineage column (kept out of payloads)."""
    return order_text(spark, sf_dir).select(F.col("batch").alias("_batch"), *TEXT_COLUMNS)


def typed_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = split_castable(_orders(spark, sf_dir), ORDER_CONTRACT.types)
    return ok.withColumnRenamed("_batch", "batch")


register("typed_ok", _ORD + """SELECT batch, o_orderkey, TRY_CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority, batch_date
FROM raw WHERE TRY_CAST(o_custkey AS INTEGER) IS NOT NULL AND TRY_CAST(o_totalprice AS DOUBLE) IS NOT NULL""",
         covers=("VAL-11", "PRJ-2", "FLT-3", "Q-1", "Q-2"))(typed_ok)


def typed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_castable(_orders(spark, sf_dir), ORDER_CONTRACT.types)
    q = from_rows(bad, F.col("_rule"), RUN, key="o_orderkey", origin="_batch")
    return q.select(F.col("source_file").alias("batch"), "rule", "record_key", "original_record")


register("typed_quarantine", _ORD + f"""
SELECT batch, 'not_numeric_o_custkey' AS rule, o_orderkey AS record_key, {_PAYLOAD} AS original_record
FROM raw WHERE TRY_CAST(o_custkey AS INTEGER) IS NULL
UNION ALL
SELECT batch, 'not_numeric_o_totalprice', o_orderkey, {_PAYLOAD}
FROM raw WHERE TRY_CAST(o_totalprice AS DOUBLE) IS NULL""",
         covers=("VAL-7", "VAL-12", "Q-17", "Q-21"))(typed_quarantine)


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status as a label: F -> 1, O -> 0, anything else (P) -> NULL."""
    o = map_label(_orders(spark, sf_dir), "o_orderstatus", positive="F", negative="O")
    return o.select(F.col("_batch").alias("batch"), "o_orderkey", "o_orderstatus")


register("label_map", _ORD + """SELECT batch, o_orderkey,
       CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS o_orderstatus FROM raw""",
         covers=("VAL-13", "Q-22"))(label_map)


_LINES = f"WITH lt AS ({LINEITEM_TEXT_SQL}),\n"
_LINE_DEDUP_CTES = _LINES + """d AS (SELECT DISTINCT * FROM lt),
v AS (SELECT file, l_key, count(*) AS n FROM d GROUP BY ALL)
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem text as read back from its CSV folders (one folder per
    ship year; the folder name is the unit, kept as a lineage column)."""
    return staged_lines(spark, sf_dir).withColumnRenamed("file", "_file")


def dedup_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = split_conflicts(_lines(spark, sf_dir), key="l_key", origin="_file")
    return ok.withColumnRenamed("_file", "file")


register("dedup_ok", _LINE_DEDUP_CTES + "SELECT d.* FROM d JOIN v USING (file, l_key) WHERE n = 1",
         covers=("VAL-8", "VAL-10", "WIN-1", "AGG-18"))(dedup_ok)


def dedup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_conflicts(_lines(spark, sf_dir), key="l_key", origin="_file")
    return bad.withColumnRenamed("_file", "file")


register("dedup_conflicts", _LINE_DEDUP_CTES + "SELECT d.* FROM d JOIN v USING (file, l_key) WHERE n > 1",
         covers=("VAL-9", "WIN-1", "Q-6"))(dedup_conflicts)


def _hot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line text with one hot key: every line of an order whose key is a
    multiple of 3 becomes a version of key ``hot`` in file ``ship_hot``, so
    one (file, key) group holds a third of all lines (no line is dropped)."""
    lt = _lines(spark, sf_dir)
    hot = F.col("l_orderkey").cast("bigint") % 3 == 0
    return lt.withColumns({"_file": F.when(hot, F.lit("ship_hot")).otherwise(F.col("_file")),
                           "l_key": F.when(hot, F.lit("hot")).otherwise(F.col("l_key"))})


def dedup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct line with the number of versions of its key in its file,
    when one key holds a third of all lines: the version count is a partial
    aggregate (one row per key and task crosses the shuffle) and the hot
    group reaches the rows through a join AQE can split, not a window buffer."""
    t = tag_versions(_hot_lines(spark, sf_dir), key="l_key", origin="_file")
    return t.withColumnRenamed("_file", "file").withColumnRenamed("__versions", "n_versions")


_HOT = "CAST(l_orderkey AS BIGINT) % 3 = 0"
register("dedup_hot_key", f"""WITH lt0 AS ({LINEITEM_TEXT_SQL}),
lt AS (SELECT CASE WHEN {_HOT} THEN 'ship_hot' ELSE file END AS file,
              CASE WHEN {_HOT} THEN 'hot' ELSE l_key END AS l_key,
              l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate
       FROM lt0),
d AS (SELECT DISTINCT * FROM lt),
v AS (SELECT file, l_key, count(*) AS n FROM d GROUP BY ALL)
SELECT d.*, v.n AS n_versions FROM d JOIN v USING (file, l_key)""",
         covers=("VAL-8", "VAL-9", "WIN-1"))(dedup_hot_key)


def lineage_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the line CSVs with their folder of origin and the run stamp."""
    lines = with_origin(staged_lines(spark, sf_dir), "_source_folder", level="folder")
    s = stamp(lines, RUN)
    return s.select(
        F.regexp_extract("_source_folder", r"file=(.*)$", 1).alias("file"), "l_key",
        F.col("_run_id").alias("run_id"),
        # rendered in UTC whatever the session time zone
        F.date_format(F.to_utc_timestamp("_ingested_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
        .alias("ingested_at"),
    )


register("lineage_stamp", _LINES.rstrip(",\n") + f"""
SELECT file, l_key, '{RUN.run_id}' AS run_id, '2026-08-31 06:00:00' AS ingested_at FROM lt""",
         covers=("VAL-14", "SRC-7", "Q-10", "Q-11"))(lineage_stamp)

# LINE_COLUMNS is re-exported for tests
__all__ = ["LINE_COLUMNS"]
