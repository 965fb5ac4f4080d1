"""Point-in-time feature queries over ``events`` x ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.bindings.registry import register
from trustfold.bindings.usage import (
    HOT_USAGE_EVENTS_SQL,
    USAGE_EVENTS_SQL,
    USAGE_METRICS,
    USAGE_RATIOS,
    WEEKLY_AS_OF,
    hot_usage_events,
    table,
    staged_events,
    usage_metrics_sql,
)
from trustfold.operators.features import window_edge_counts, window_metrics, with_as_of
from trustfold.plans.gold import build_gold


def _week_case(expr: str) -> str:
    """SQL CASE mapping ``expr % 4`` to one of the weekly dates (as text)."""
    arms = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(WEEKLY_AS_OF))
    return f"CASE ({expr}) % 4 {arms} END"


def _week_col(expr) -> F.Column:
    out = None
    for i, d in enumerate(WEEKLY_AS_OF):
        out = (F.when(expr % 4 == i, F.lit(d)) if out is None else out.when(expr % 4 == i, F.lit(d)))
    return out


def customer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as weekly batch members: every customer is in batch
    ``key % 4``; every fifth customer is also in the following week's batch.
    Columns: entity_id, c_name, c_mktsegment, c_acctbal, batch_date (text)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    dates = F.array(_week_col(k), F.when(k % 5 == 0, _week_col(k + 1)))
    return (
        c.select(k.alias("entity_id"), "c_name", "c_mktsegment", "c_acctbal",
                 F.explode(dates).alias("batch_date"))
        .where(F.col("batch_date").isNotNull())
    )


CUSTOMER_BATCHES_SQL = f"""
SELECT c_custkey AS entity_id, c_name, c_mktsegment, c_acctbal, {_week_case('c_custkey')} AS batch_date
FROM customer
UNION ALL
SELECT c_custkey, c_name, c_mktsegment, c_acctbal, {_week_case('c_custkey + 1')}
FROM customer WHERE c_custkey % 5 = 0
"""

# ---------------------------------------------------------------- fixed as-of


def pit_usage_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    snaps = with_as_of(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id")),
                       date="2024-01-29")
    return window_metrics(staged_events(spark, sf_dir), snaps, key="entity_id", day="day",
                          as_of="as_of", horizon_days=14, metrics=USAGE_METRICS, ratios=USAGE_RATIOS)


register(
    "pit_usage_fixed",
    usage_metrics_sql("SELECT c_custkey AS entity_id, DATE '2024-01-29' AS as_of FROM customer", 14),
    covers=("PRJ-3", "FLT-1", "JN-1", "JN-2", "AGG-1", "AGG-2", "AGG-3", "AGG-4", "AGG-18", "PRJ-5", "Q-20", "Q-25"),
)(pit_usage_fixed)

# ------------------------------------------------------ far apart snapshots

# Two dates whose windows leave most of the month between them uncovered.
FAR_AS_OF, FAR_DAYS = ("2024-01-05", "2024-01-29"), 3


def pit_usage_far_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of every customer, weeks apart: only the days of the two windows are read."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"))
    snaps = customers.select("entity_id", F.explode(F.array(*(F.to_date(F.lit(d)) for d in FAR_AS_OF))).alias("as_of"))
    return window_metrics(staged_events(spark, sf_dir), snaps, key="entity_id", day="day",
                          as_of="as_of", horizon_days=FAR_DAYS, metrics=USAGE_METRICS, ratios=USAGE_RATIOS)


register(
    "pit_usage_far_apart",
    usage_metrics_sql(" UNION ALL ".join(f"SELECT c_custkey AS entity_id, DATE '{d}' AS as_of FROM customer" for d in FAR_AS_OF), FAR_DAYS),
    covers=("FLT-1", "JN-1"),
)(pit_usage_far_apart)

# ---------------------------------------------------------- per-row as-of


def _batch_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_as_of(customer_batches(spark, sf_dir), column="batch_date").select("entity_id", "as_of")


_BATCH_SNAPS_SQL = f"SELECT entity_id, CAST(batch_date AS DATE) AS as_of FROM ({CUSTOMER_BATCHES_SQL}) b"


def pit_usage_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_metrics(staged_events(spark, sf_dir), _batch_snapshots(spark, sf_dir), key="entity_id",
                          day="day", as_of="as_of", horizon_days=14, metrics=USAGE_METRICS,
                          ratios=USAGE_RATIOS)


register("pit_usage_by_batch", usage_metrics_sql(_BATCH_SNAPS_SQL, 14),
         covers=("PRJ-4", "JN-1", "Q-24"))(pit_usage_by_batch)


def pit_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same answer as ``pit_usage_by_batch`` through the interval-join strategy."""
    return window_metrics(staged_events(spark, sf_dir), _batch_snapshots(spark, sf_dir), key="entity_id",
                          day="day", as_of="as_of", horizon_days=14, metrics=USAGE_METRICS,
                          ratios=USAGE_RATIOS, strategy="join")


register("pit_daily_rollup", usage_metrics_sql(_BATCH_SNAPS_SQL, 14), covers=("P-6",))(pit_daily_rollup)


def pit_usage_90d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production horizon (90 days) on the weekly snapshots."""
    return window_metrics(staged_events(spark, sf_dir), _batch_snapshots(spark, sf_dir), key="entity_id",
                          day="day", as_of="as_of", horizon_days=90, metrics=USAGE_METRICS,
                          ratios=USAGE_RATIOS)


register("pit_usage_90d", usage_metrics_sql(_BATCH_SNAPS_SQL, 90), covers=("JN-1",))(pit_usage_90d)



def pit_hot_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly snapshots over events where one entity holds a third of all
    events: the daily roll-up leaves that entity one row per day before the
    shuffle, so its window partition is as small as anyone's."""
    return window_metrics(hot_usage_events(spark, sf_dir), _batch_snapshots(spark, sf_dir), key="entity_id",
                          day="day", as_of="as_of", horizon_days=14, metrics=USAGE_METRICS,
                          ratios=USAGE_RATIOS)


register("pit_hot_entity", usage_metrics_sql(_BATCH_SNAPS_SQL, 14, HOT_USAGE_EVENTS_SQL),
         covers=("JN-1", "AGG-1", "P-6"))(pit_hot_entity)



def pit_no_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty snapshot set over the whole event table: no day is in range,
    so nothing is read and no metrics row comes out; events counted beside it."""
    empty = _batch_snapshots(spark, sf_dir).where(F.col("as_of") > F.to_date(F.lit("9999-01-01")))
    events = staged_events(spark, sf_dir)
    got = window_metrics(events, empty, key="entity_id", day="day", as_of="as_of", horizon_days=14,
                         metrics=USAGE_METRICS, ratios=USAGE_RATIOS)
    counts = [got.agg(F.lit("metrics").alias("part"), F.count(F.lit(1)).alias("n_rows")),
              events.agg(F.lit("events").alias("part"), F.count(F.lit(1)).alias("n_rows"))]
    return counts[0].unionByName(counts[1])


register("pit_no_snapshots", """SELECT 'events' AS part, count(*) AS n_rows FROM events
UNION ALL SELECT 'metrics', count(*) FROM customer WHERE c_custkey IS NULL""", covers=("FLT-2",))(pit_no_snapshots)

# ----------------------------------------------------------- window edges


def pit_window_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per (as-of, days before as-of) inside a 7-day window: offsets
    run 1..7, the as-of day itself never appears."""
    return window_edge_counts(staged_events(spark, sf_dir), _batch_snapshots(spark, sf_dir), key="entity_id",
                              day="day", as_of="as_of", horizon_days=7)


register(
    "pit_window_edges",
    f"""
WITH ev AS ({USAGE_EVENTS_SQL}), s AS (SELECT DISTINCT * FROM ({_BATCH_SNAPS_SQL}) x)
SELECT s.as_of, CAST(datediff('day', e.day, s.as_of) AS INTEGER) AS days_before,
       count(*) AS n_events, count(DISTINCT e.entity_id) AS n_entities
FROM ev e JOIN s ON e.entity_id = s.entity_id
 AND e.day >= CAST(s.as_of - INTERVAL 7 DAY AS DATE) AND e.day < s.as_of
GROUP BY 1, 2
""",
    covers=("Q-23", "JN-1"),
)(pit_window_edges)

# ------------------------------------------------------------------- gold


def _gold_sql(batches_sql: str, as_of_expr: str, horizon: int, events_sql: str = USAGE_EVENTS_SQL) -> str:
    return f"""
WITH t AS (SELECT *, {as_of_expr} AS as_of FROM ({batches_sql}) b),
f AS ({usage_metrics_sql("SELECT entity_id, as_of FROM t WHERE entity_id IS NOT NULL AND as_of IS NOT NULL", horizon, events_sql)})
SELECT t.entity_id, t.as_of, t.c_name, t.c_mktsegment, t.c_acctbal, t.batch_date,
       f.n_calls, f.call_minutes, f.data_mb, f.n_tickets, f.n_dropped, f.drop_rate
FROM t LEFT JOIN f ON t.entity_id = f.entity_id AND t.as_of = f.as_of
"""


def gold_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(customer_batches(spark, sf_dir), staged_events(spark, sf_dir), key="entity_id",
                      as_of_column="batch_date", horizon_days=14, metrics=USAGE_METRICS,
                      ratios=USAGE_RATIOS)


register("gold_profile", _gold_sql(CUSTOMER_BATCHES_SQL, "CAST(batch_date AS DATE)", 14),
         covers=("JN-3", "Q-26", "PRJ-4"))(gold_profile)


def gold_fixed_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One labelled snapshot for all customers (literal as-of, 90-day window)."""
    return build_gold(customer_batches(spark, sf_dir), staged_events(spark, sf_dir), key="entity_id",
                      as_of_date="2024-01-29", horizon_days=90, metrics=USAGE_METRICS,
                      ratios=USAGE_RATIOS)


register("gold_fixed_date", _gold_sql(CUSTOMER_BATCHES_SQL, "DATE '2024-01-29'", 90),
         covers=("JN-3", "PRJ-3"))(gold_fixed_date)


def gold_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted rows keyed by text, as raw batches are, with zero-padded copies
    of some keys: every row stays one row, and a padded key is another key."""
    b = customer_batches(spark, sf_dir)
    k = F.col("entity_id")
    plain = b.withColumn("entity_id", k.cast("string"))
    padded = b.where(k % 3 == 0).withColumn("entity_id", F.concat(F.lit("00"), k.cast("string")))
    return build_gold(plain.unionByName(padded), staged_events(spark, sf_dir), key="entity_id", as_of_column="batch_date",
                      horizon_days=14, metrics=USAGE_METRICS, ratios=USAGE_RATIOS)


_TEXT_KEY_SQL = f"""
SELECT CAST(entity_id AS VARCHAR) AS entity_id, c_name, c_mktsegment, c_acctbal, batch_date FROM ({CUSTOMER_BATCHES_SQL}) b
UNION ALL
SELECT '00' || CAST(entity_id AS VARCHAR), c_name, c_mktsegment, c_acctbal, batch_date FROM ({CUSTOMER_BATCHES_SQL}) b WHERE entity_id % 3 = 0
"""
_TEXT_EVENTS_SQL = f"SELECT * REPLACE (CAST(entity_id AS VARCHAR) AS entity_id) FROM ({USAGE_EVENTS_SQL}) u"

register("gold_text_key", _gold_sql(_TEXT_KEY_SQL, "CAST(batch_date AS DATE)", 14, _TEXT_EVENTS_SQL),
         covers=("JN-3", "Q-8"))(gold_text_key)


_BAD_DATES_SQL = f"""
SELECT entity_id, c_name, c_mktsegment, c_acctbal,
       CASE WHEN entity_id % 13 = 0 THEN 'bad-date' WHEN entity_id % 17 = 0 THEN NULL ELSE batch_date END AS batch_date
FROM ({CUSTOMER_BATCHES_SQL}) b
"""


def gold_null_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unparseable or missing batch dates give a NULL as-of and NULL
    features, but the row stays (row count equals the trusted input)."""
    b = customer_batches(spark, sf_dir)
    k = F.col("entity_id")
    b = b.withColumn("batch_date", F.when(k % 13 == 0, F.lit("bad-date"))
                     .when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("batch_date")))
    return build_gold(b, staged_events(spark, sf_dir), key="entity_id", as_of_column="batch_date",
                      horizon_days=14, metrics=USAGE_METRICS, ratios=USAGE_RATIOS)


register("gold_null_asof", _gold_sql(_BAD_DATES_SQL, "TRY_CAST(batch_date AS DATE)", 14),
         covers=("Q-8", "Q-9"))(gold_null_asof)
