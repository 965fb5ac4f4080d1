"""Binding of the driver's ``events`` / ``customer`` tables to the usage model.

The usage model has one row per event: entity, timestamp, kind (``call``,
``data``, ``ticket``), call duration in seconds, data volume, dropped-call
flag, and the event day.  The driver's table is mapped as follows (fixed
values, chosen for this binding):

* entity = ``user_id``; day = ``CAST(ts AS DATE)``
* ``click`` -> ``call``, ``purchase`` -> ``data``, ``error`` -> ``ticket``;
  other kinds keep their name and feed no metric
* duration (calls) and volume (data) = ``value`` in integer hundredths, so
  sums are exact in every engine
* dropped (calls only) = ``event_id % 10 = 0``
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.operators.features import Metric, Ratio
from trustfold.session import scratch_path

_lock = threading.Lock()
_staged: dict[tuple[str, str], str] = {}

# Snapshot dates of the weekly batches used by the binding.
WEEKLY_AS_OF = ["2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"]

USAGE_METRICS = [
    Metric("n_calls", "count", when="kind = 'call'"),
    Metric("call_minutes", "sum", when="kind = 'call'", value="duration_s", divide_by=60.0),
    Metric("data_mb", "sum", when="kind = 'data'", value="mb"),
    Metric("n_tickets", "count", when="kind = 'ticket'"),
    Metric("n_dropped", "count", when="kind = 'call' AND dropped"),
]
USAGE_RATIOS = [Ratio("drop_rate", "n_dropped", "n_calls")]

USAGE_COLUMNS = ["n_calls", "call_minutes", "data_mb", "n_tickets", "n_dropped", "drop_rate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the usage model (entity_id, event_ts, kind, duration_s, mb, dropped, day)."""
    ev = table(spark, sf_dir, "events")
    kind = (
        F.when(F.col("event_type") == "click", "call")
        .when(F.col("event_type") == "purchase", "data")
        .when(F.col("event_type") == "error", "ticket")
        .otherwise(F.col("event_type"))
    )
    cents = F.round(F.col("value") * 100)
    return ev.select(
        F.col("user_id").alias("entity_id"),
        F.col("ts").alias("event_ts"),
        kind.alias("kind"),
        F.when(kind == "call", cents.cast("int")).alias("duration_s"),
        F.when(kind == "data", cents.cast("float")).alias("mb"),
        F.when(kind == "call", (F.col("event_id") % 10) == 0).alias("dropped"),
        F.col("ts").cast("date").alias("day"),
    )


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage events as a day-partitioned parquet table, written once per
    session and read back: window queries open only the days they need."""
    at = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if at not in _staged:
            root = scratch_path(spark, "usage_by_day")
            usage_events(spark, sf_dir).write.partitionBy("day").parquet(root)
            _staged[at] = root
        return spark.read.parquet(_staged[at])


# SQL twin of ``usage_events`` for the DuckDB oracle.
USAGE_EVENTS_SQL = """
SELECT user_id AS entity_id, ts AS event_ts,
       CASE event_type WHEN 'click' THEN 'call' WHEN 'purchase' THEN 'data'
                       WHEN 'error' THEN 'ticket' ELSE event_type END AS kind,
       CASE WHEN event_type = 'click' THEN CAST(round(value * 100) AS BIGINT) END AS duration_s,
       CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END AS mb,
       CASE WHEN event_type = 'click' THEN event_id % 10 = 0 END AS dropped,
       CAST(ts AS DATE) AS day
FROM events
"""


def usage_metrics_sql(snaps_sql: str, horizon: int, events_sql: str = USAGE_EVENTS_SQL) -> str:
    """Oracle SQL: window metrics for the snapshot relation ``snaps_sql``
    (columns entity_id, as_of) over ``events_sql`` (the usage model)."""
    return f"""
WITH ev AS ({events_sql}),
snaps AS (SELECT DISTINCT entity_id, as_of FROM ({snaps_sql}) s0),
m AS (
  SELECT s.entity_id, s.as_of,
         count(e.kind) FILTER (WHERE e.kind = 'call') AS n_calls,
         sum(e.duration_s) FILTER (WHERE e.kind = 'call') AS call_sec,
         sum(e.mb) FILTER (WHERE e.kind = 'data') AS data_mb,
         count(e.kind) FILTER (WHERE e.kind = 'ticket') AS n_tickets,
         count(e.kind) FILTER (WHERE e.kind = 'call' AND e.dropped) AS n_dropped
  FROM snaps s
  LEFT JOIN ev e
    ON e.entity_id = s.entity_id
   AND e.day >= CAST(s.as_of - INTERVAL {int(horizon)} DAY AS DATE)
   AND e.day < s.as_of
  GROUP BY s.entity_id, s.as_of)
SELECT entity_id, as_of,
       CAST(n_calls AS BIGINT) AS n_calls,
       CAST(coalesce(call_sec, 0) AS DOUBLE) / 60.0 AS call_minutes,
       CAST(coalesce(data_mb, 0) AS DOUBLE) AS data_mb,
       CAST(n_tickets AS BIGINT) AS n_tickets,
       CAST(n_dropped AS BIGINT) AS n_dropped,
       CASE WHEN n_calls > 0 THEN CAST(n_dropped AS DOUBLE) / n_calls END AS drop_rate
FROM m
"""


def hot_usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage events with one hot entity: every event of a user whose id is
    a multiple of 3 is re-keyed to entity 0, so entity 0 holds about a third
    of all events (no event is dropped)."""
    ev = staged_events(spark, sf_dir)
    k = F.col("entity_id")
    return ev.withColumn("entity_id", F.when(k % 3 == 0, F.lit(0).cast("bigint")).otherwise(k))


HOT_USAGE_EVENTS_SQL = f"""
SELECT CASE WHEN entity_id % 3 = 0 THEN CAST(0 AS BIGINT) ELSE entity_id END AS entity_id,
       event_ts, kind, duration_s, mb, dropped, day
FROM ({USAGE_EVENTS_SQL}) u
"""
