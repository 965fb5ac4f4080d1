"""Queries answered from mergeable summaries, and the ragged-row report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.bindings.order_batches import ORDER_CONTRACT, RAW_TEXT_CTE, order_text
from trustfold.bindings.q_profile import _EV, _lines_sql, _once, staged_lines
from trustfold.bindings.registry import register
from trustfold.bindings.usage import staged_events
from trustfold.operators.sketches import (
    KLL_RANK_ERROR,
    active_entities,
    entity_bitmaps,
    frequent_values_per_column,
    quantile_sketches,
    rank_errors,
    sketched_quantiles,
)
from trustfold.session import materialize, scratch_path
from trustfold.sources.batches import ragged_rows

_ORD = f"WITH {RAW_TEXT_CTE.strip()}\n"


def order_quantiles_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of every typed column from one sketch per batch, merged over all
    batches; each is held against its exact rank: true where the error stays
    within the stated bound."""
    text = order_text(spark, sf_dir)
    per_batch = materialize(quantile_sketches(text, ["batch"], ORDER_CONTRACT.types), "quantile_sketches")
    found = materialize(sketched_quantiles(per_batch), "sketched_quantiles")
    return rank_errors(text, found, ORDER_CONTRACT.types).select("column_name", "prob", "n", (F.col("rank_error") <= KLL_RANK_ERROR).alias("within_bound"))


register(
    "order_quantiles_sketch",
    _ORD + ", x AS (SELECT 'o_custkey' AS column_name, CAST(TRY_CAST(o_custkey AS INTEGER) AS DOUBLE) AS v FROM raw "
    "UNION ALL SELECT 'o_totalprice', TRY_CAST(o_totalprice AS DOUBLE) FROM raw)\n"
    "SELECT column_name, CAST(p AS DOUBLE) AS prob, count(v) AS n, true AS within_bound FROM x, (VALUES (0.25), (0.5), (0.75)) t(p) GROUP BY column_name, p",
    covers=("AGG-16",),
)(order_quantiles_sketch)


def wide_column_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2 most frequent values of columns of few, many and almost only distinct
    values, through frequent-items summaries."""
    lines = staged_lines(spark, sf_dir)
    code = F.when(F.col("l_linenumber") == "1", "first").when(F.col("l_linenumber") == "2", "second").otherwise(F.col("l_key"))
    return frequent_values_per_column(lines.withColumn("code", code), ["code", "l_quantity", "l_extendedprice", "l_returnflag", "absent"], k=2)


register(
    "wide_column_top",
    _lines_sql(""", kv AS (
  SELECT 'code' AS column_name, CASE l_linenumber WHEN '1' THEN 'first' WHEN '2' THEN 'second' ELSE l_key END AS value FROM lt
  UNION ALL SELECT 'l_quantity', l_quantity FROM lt
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lt
  UNION ALL SELECT 'l_returnflag', l_returnflag FROM lt),
c AS (SELECT column_name, value, count(*) AS n_rows FROM kv GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, value ASC NULLS FIRST) AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 2"""),
    covers=("AGG-15", "SRT-2"),
)(wide_column_top)


def active_entities_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct active entities per day and over the 7 days that end with it, from
    one bitmap a day and block of ids."""
    bitmaps = materialize(entity_bitmaps(staged_events(spark, sf_dir), day="day", key="entity_id"), "entity_bitmaps")
    return active_entities(bitmaps, {"n_day": 1, "n_week": 7})


register(
    "active_entities_by_day",
    _EV + """SELECT d.day, count(DISTINCT CASE WHEN e.day = d.day THEN e.entity_id END) AS n_day, count(DISTINCT e.entity_id) AS n_week
FROM (SELECT DISTINCT day FROM ev) d JOIN ev e ON e.day <= d.day AND e.day > d.day - 7 GROUP BY d.day""",
    covers=("AGG-5", "AGG-10"),
)(active_entities_by_day)

# ------------------------------------------------------------- ragged rows

_RAGGED_HEADER = "o_orderkey,o_orderpriority,o_orderstatus"


def _ragged_lines(spark: SparkSession, sf_dir: str) -> str:
    """The orders as hand-made CSV lines, one folder per order year.

    Derived: the last field is missing when key % 53 = 0, one is added when
    key % 59 = 0 (also quoted, with a comma inside, when key % 118 = 0), and
    the last of three is empty when key % 61 = 0."""
    def make() -> str:
        o = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
        k = F.col("o_orderkey")
        start = F.concat_ws(",", k.cast("string"), "o_orderpriority")
        line = (F.when(k % 53 == 0, start)
                .when(k % 59 == 0, F.concat(start, F.lit(","), F.col("o_orderstatus"), F.when(k % 118 == 0, F.lit(',"a, b"')).otherwise(F.lit(",x"))))
                .when(k % 61 == 0, F.concat(start, F.lit(",")))
                .otherwise(F.concat(start, F.lit(","), F.col("o_orderstatus"))))
        root = scratch_path(spark, "ragged")
        # a separator that no line holds, so that Spark writes lines and header as they are
        (o.select(line.alias(_RAGGED_HEADER), F.year("o_orderdate").alias("year")).write.partitionBy("year")
         .option("header", True).option("sep", "\x02").option("quoteAll", False).option("escapeQuotes", False).option("quote", "\x03").csv(root))
        return root

    return _once(spark, sf_dir, "ragged", make)


def ragged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, short rows and long rows of the batches, per year."""
    per_file = ragged_rows(spark, [_ragged_lines(spark, sf_dir)])
    year = F.regexp_extract("source_file", "year=([0-9]+)", 1).cast("int").alias("year")
    return per_file.groupBy(year).agg(*(F.sum(c).alias(c) for c in ("n_rows", "n_short", "n_long")))


register(
    "ragged_batches",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey % 53 = 0) AS n_short,
       count(*) FILTER (WHERE o_orderkey % 53 <> 0 AND o_orderkey % 59 = 0) AS n_long FROM orders GROUP BY ALL""",
    covers=("SRC-1", "Q-15"),
)(ragged_batches)
