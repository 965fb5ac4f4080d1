"""Profiling and coverage queries.

Inputs (all derived by Spark from the driver's tables, staged once per
session in the shared scratch folder):

* usage events written day-partitioned (``day=YYYY-MM-DD`` folders) and read
  back with partition discovery;
* ``lineitem`` as raw text CSV, one folder per ship year (``file=ship_YYYY``),
  with derived junk and identical copies; unit = folder;
* the order text records and batch folders of the trust stage.

Fixed values of the lineitem binding: key = ``l_orderkey || '-' ||
l_linenumber``; junk index j = ``l_orderkey * 8 + l_linenumber``:
quantity ``' '`` when j % 97 = 0, ``'abc'`` when % 89, NULL when % 83;
price ``'n/a'`` when j % 101 = 0; discount ``' '`` when j % 103 = 0;
identical copy of line 1 of every order with l_orderkey % 40 = 0.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.bindings.order_batches import BATCH_LAYOUTS, ORDER_CONTRACT, RAW_TEXT_CTE, order_text
from trustfold.bindings.q_features import CUSTOMER_BATCHES_SQL, customer_batches
from trustfold.bindings.q_trusted import staged_batches
from trustfold.bindings.registry import register
from trustfold.bindings.usage import USAGE_EVENTS_SQL, staged_events, table, usage_events
from trustfold.operators import coverage, profile
from trustfold.session import scratch_path, unsorted_writer
from trustfold.sources.batches import ragged_rows, read_headers

_lock = threading.Lock()
_staged: dict[tuple[str, str, str], str] = {}

LINE_TYPES = {"l_quantity": "double", "l_extendedprice": "double", "l_discount": "double"}
LINE_COLUMNS = ["l_key", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_returnflag", "l_linestatus", "l_shipdate"]


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _staged:
            _staged[key] = make()
        return _staged[key]


def _dec(col: str):
    cents = F.round(F.col(col) * 100).cast("bigint")
    return F.concat(F.expr(f"cast(round({col} * 100) as bigint) div 100").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def _dec_sql(col: str) -> str:
    c = f"CAST(round({col} * 100) AS BIGINT)"
    return f"CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0')"


def lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    j = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    base = li.select(
        F.concat(F.lit("ship_"), F.year("l_shipdate").cast("string")).alias("file"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("l_key"),
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.when(j % 97 == 0, F.lit(" ")).when(j % 89 == 0, F.lit("abc"))
        .when(j % 83 == 0, F.lit(None).cast("string")).otherwise(_dec("l_quantity")).alias("l_quantity"),
        F.when(j % 101 == 0, F.lit("n/a")).otherwise(_dec("l_extendedprice")).alias("l_extendedprice"),
        F.when(j % 103 == 0, F.lit(" ")).otherwise(_dec("l_discount")).alias("l_discount"),
        "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        F.col("l_orderkey").alias("__k"), F.col("l_linenumber").alias("__n"),
    )
    # a line and its copy side by side: one scan, and one file a task and folder where they are written
    twice = (F.col("__k") % 40 == 0) & (F.col("__n") == 1)
    return base.withColumn("__copy", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("__k", "__n", "__copy")


LINEITEM_TEXT_SQL = f"""
WITH li AS (SELECT *, l_orderkey * 8 + l_linenumber AS j FROM lineitem),
base AS (
  SELECT 'ship_' || CAST(year(l_shipdate) AS VARCHAR) AS file,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS l_key,
         CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         CASE WHEN j % 97 = 0 THEN ' ' WHEN j % 89 = 0 THEN 'abc' WHEN j % 83 = 0 THEN NULL
              ELSE {_dec_sql('l_quantity')} END AS l_quantity,
         CASE WHEN j % 101 = 0 THEN 'n/a' ELSE {_dec_sql('l_extendedprice')} END AS l_extendedprice,
         CASE WHEN j % 103 = 0 THEN ' ' ELSE {_dec_sql('l_discount')} END AS l_discount,
         l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
         li.l_orderkey AS k, li.l_linenumber AS n
  FROM li)
SELECT file, l_key, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate
FROM base
UNION ALL
SELECT file, l_key, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_shipdate
FROM base WHERE k % 40 = 0 AND n = 1
"""


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem text as CSV folders per ship year, read back as one
    multi-file, all-text CSV scan (the folder name becomes ``file``)."""
    def make() -> str:
        root = scratch_path(spark, "lineitem_csv")
        (lineitem_text(unsorted_writer(spark), sf_dir).write.partitionBy("file").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(root))
        return root
    root = _once(spark, sf_dir, "lines", make)
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField(c, StringType(), True) for c in LINE_COLUMNS] +
                        [StructField("file", StringType(), True)])
    return spark.read.csv(root, header=True, schema=schema)


def _lines_sql(body: str) -> str:
    return f"WITH lt AS ({LINEITEM_TEXT_SQL})\n{body}"


# =============================================================== headers

def headers_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column count, exact header and data rows of every batch folder's files, with how many rows do not fit the header."""
    paths = staged_batches(spark, sf_dir)
    heads = read_headers(spark, paths)
    h = profile.headers_per_file(heads).join(ragged_rows(spark, paths, heads), "source_file")
    return (h.groupBy(F.regexp_extract("source_file", r"batch=([^/]+)", 1).alias("batch"), "n_columns", F.to_json(F.col("header")).alias("header"))
            .agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("n_short") + F.col("n_long")).alias("n_ragged")))


def _headers_sql() -> str:
    import json
    vals = ", ".join(
        f"('{b}', {len(lay)}, '{json.dumps(lay, separators=(',', ':'))}')" for b, lay in sorted(BATCH_LAYOUTS.items())
    )
    return (f"WITH {RAW_TEXT_CTE.strip()}\nSELECT t.batch, CAST(n_columns AS INTEGER) AS n_columns, header, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_ragged "
            f"FROM (VALUES {vals}) t(batch, n_columns, header) JOIN raw ON raw.batch = t.batch GROUP BY ALL")


register("headers_per_file", _headers_sql(), covers=("SRC-9", "SRC-2"))(headers_per_file)


def event_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema of the day-partitioned event table as discovered on read (the
    partition column comes back as a date), and how many NULLs each column holds."""
    ev = staged_events(spark, sf_dir)
    held = profile.nulls_and_blanks(ev, ev.columns).select("column_name", "n_null")
    return profile.schema_rows(spark, ev.schema).join(held, "column_name").select(
        "position", "column_name", "data_type", "nullable", "n_null")


_EVENT_COLUMNS = {"entity_id": "bigint", "event_ts": "timestamp_ntz", "kind": "string", "duration_s": "int", "mb": "float", "dropped": "boolean", "day": "date"}

register(
    "event_schema",
    f"WITH ev AS ({USAGE_EVENTS_SQL})\n" + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS data_type, true AS nullable, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM ev"
        for i, (c, t) in enumerate(_EVENT_COLUMNS.items())),
    covers=("SRC-10", "SRC-4"),
)(event_schema)

# ================================================================ events

_EV = f"WITH ev AS ({USAGE_EVENTS_SQL})\n"


def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.daily_activity(staged_events(spark, sf_dir), day="day", key="entity_id", ts="event_ts")


register("daily_activity", _EV + """SELECT day, count(*) AS n_events, count(DISTINCT entity_id) AS n_entities,
       min(event_ts) AS first_ts, max(event_ts) AS last_ts FROM ev GROUP BY day""",
         covers=("AGG-5", "SRC-4", "SRT-1"))(daily_activity)


def kind_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequencies(staged_events(spark, sf_dir), ["day", "kind"]).orderBy("day", "kind")


register("kind_by_day", _EV + "SELECT day, kind, count(*) AS n_rows FROM ev GROUP BY day, kind",
         covers=("AGG-6",))(kind_by_day)


def kind_by_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frequencies(staged_events(spark, sf_dir), ["kind", "dropped"])


register("kind_by_dropped", _EV + "SELECT kind, dropped, count(*) AS n_rows FROM ev GROUP BY kind, dropped",
         covers=("AGG-6",))(kind_by_dropped)


def kind_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = staged_events(spark, sf_dir).withColumn("mb", F.col("mb").cast("double"))
    return profile.ranges(ev, "kind", ["duration_s", "mb"])


register("kind_ranges", _EV + """SELECT kind, CAST(min(duration_s) AS INTEGER) AS min_duration_s,
       CAST(max(duration_s) AS INTEGER) AS max_duration_s, CAST(min(mb) AS DOUBLE) AS min_mb,
       CAST(max(mb) AS DOUBLE) AS max_mb FROM ev GROUP BY kind""",
         covers=("AGG-8",))(kind_ranges)


def event_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count of every event column (one aggregate)."""
    ev = staged_events(spark, sf_dir)
    return profile.nulls_and_blanks(ev, ev.columns).select("column_name", "n_null")


register(
    "event_nulls",
    _EV + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM ev"
        for c in ["entity_id", "event_ts", "kind", "duration_s", "mb", "dropped", "day"]
    ),
    covers=("AGG-7",),
)(event_nulls)

# ============================================================ order text

_ORD = f"WITH {RAW_TEXT_CTE.strip()}\n"
_ORDER_TEXT_COLS = list(ORDER_CONTRACT.columns)


def order_nulls_and_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.nulls_and_blanks(order_text(spark, sf_dir), _ORDER_TEXT_COLS)


register(
    "order_nulls_and_blanks",
    _ORD + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"count(*) FILTER (WHERE trim({c}) = '') AS n_blank FROM raw"
        for i, c in enumerate(_ORDER_TEXT_COLS)
    ),
    covers=("AGG-7", "FLT-5"),
)(order_nulls_and_blanks)


def order_uncastable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.uncastable_values(order_text(spark, sf_dir), ORDER_CONTRACT.types)


register(
    "order_uncastable",
    _ORD + """, bad AS (
  SELECT 'o_custkey' AS column_name, o_custkey AS value FROM raw WHERE o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS INTEGER) IS NULL
  UNION ALL
  SELECT 'o_totalprice', o_totalprice FROM raw WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DOUBLE) IS NULL),
v AS (SELECT column_name, value, count(*) AS n FROM bad GROUP BY ALL)
SELECT column_name, CAST(sum(n) AS BIGINT) AS n_uncastable, list(value ORDER BY value)[1:5] AS examples
FROM v GROUP BY column_name""",
    covers=("FLT-4", "AGG-20", "SRT-3"),
)(order_uncastable)


def order_numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_summary(order_text(spark, sf_dir), ORDER_CONTRACT.types, digits=3)


register(
    "order_numeric_summary",
    _ORD + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(v) AS n, round(avg(v), 3) AS mean, round(stddev_samp(v), 3) AS stddev, "
        f"min(v) AS min, max(v) AS max FROM (SELECT {cast} AS v FROM raw) x"
        for c, cast in [("o_custkey", "CAST(TRY_CAST(o_custkey AS INTEGER) AS DOUBLE)"),
                        ("o_totalprice", "TRY_CAST(o_totalprice AS DOUBLE)")]
    ),
    covers=("AGG-16",),
)(order_numeric_summary)


def order_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of every typed column."""
    return profile.numeric_quantiles(order_text(spark, sf_dir), ORDER_CONTRACT.types)


register(
    "order_quantiles",
    _ORD + "\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, [quantile_disc(x, 0.25), quantile_disc(x, 0.5), quantile_disc(x, 0.75)] AS quantiles FROM (SELECT {cast} AS x FROM raw)"
        for c, cast in [("o_custkey", "CAST(TRY_CAST(o_custkey AS INTEGER) AS DOUBLE)"),
                        ("o_totalprice", "TRY_CAST(o_totalprice AS DOUBLE)")]
    ),
    covers=("AGG-16",),
)(order_quantiles)


def category_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 values of each categorical column present (absent ones skipped)."""
    return profile.top_values_per_column(
        order_text(spark, sf_dir), ["o_orderstatus", "o_orderpriority", "batch_date", "payment_method"], k=3
    )


register(
    "category_top",
    _ORD + """, kv AS (
  SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM raw
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM raw
  UNION ALL SELECT 'batch_date', batch_date FROM raw),
c AS (SELECT column_name, value, count(*) AS n_rows FROM kv GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, value ASC NULLS FIRST) AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 3""",
    covers=("AGG-15", "SRT-2"),
)(category_top)

# ============================================================ lineitem CSV


def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rows_per_group(staged_lines(spark, sf_dir), "file")


register("rows_per_file", _lines_sql("SELECT file, count(*) AS n_rows FROM lt GROUP BY file"),
         covers=("AGG-12", "SRC-3", "SRC-7"))(rows_per_file)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_keys(staged_lines(spark, sf_dir), unit="file", key="l_key")


register("duplicate_keys", _lines_sql(
    "SELECT file, l_key, count(*) AS n_rows FROM lt GROUP BY file, l_key HAVING count(*) > 1"),
    covers=("AGG-13", "FLT-7"))(duplicate_keys)


def duplicate_keys_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 most repeated keys within a file (ties by file, key)."""
    d = profile.duplicate_keys(staged_lines(spark, sf_dir), unit="file", key="l_key")
    return d.orderBy(F.desc("n_rows"), "file", "l_key").limit(5)


register("duplicate_keys_top", _lines_sql(
    "SELECT file, l_key, count(*) AS n_rows FROM lt GROUP BY file, l_key HAVING count(*) > 1 "
    "ORDER BY n_rows DESC, file, l_key LIMIT 5"),
    covers=("AGG-13", "SRT-2"))(duplicate_keys_top)


def keys_across_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.keys_across_units(staged_lines(spark, sf_dir), unit="file", key="l_key")


register("keys_across_files", _lines_sql(
    "SELECT l_key, count(DISTINCT file) AS n_units FROM lt GROUP BY l_key HAVING count(DISTINCT file) > 1"),
    covers=("AGG-14", "AGG-18"))(keys_across_files)


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_rows(staged_lines(spark, sf_dir), unit="file", key="l_key")


register("duplicate_rows", _lines_sql(
    "SELECT lt.* FROM lt JOIN (SELECT file, l_key FROM lt GROUP BY ALL HAVING count(*) > 1) d "
    "ON lt.file = d.file AND lt.l_key = d.l_key"),
    covers=("JN-4",))(duplicate_rows)


def duplicate_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_kind(staged_lines(spark, sf_dir), unit="file", key="l_key", cols=LINE_COLUMNS)


register("duplicate_kind", _lines_sql(
    f"""SELECT file, l_key, count(*) AS n_rows, count(DISTINCT ({', '.join(LINE_COLUMNS)})) AS n_versions,
       count(DISTINCT ({', '.join(LINE_COLUMNS)})) = 1 AS identical
FROM lt GROUP BY file, l_key HAVING count(*) > 1"""),
    covers=("AGG-17", "Q-7"))(duplicate_kind)


def _flagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.dirty_flags(staged_lines(spark, sf_dir), LINE_TYPES)


def _dirty_sql(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '' OR TRY_CAST(trim({c}) AS DOUBLE) IS NULL)"


_N_DIRTY = " + ".join(f"CAST({_dirty_sql(c)} AS INTEGER)" for c in LINE_TYPES)


def dirty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.dirty_summary(_flagged_lines(spark, sf_dir), "file", LINE_TYPES)


register("dirty_summary", _lines_sql(
    f"""SELECT file, count(*) AS n_rows, count(*) FILTER (WHERE {_N_DIRTY} > 0) AS n_dirty_rows,
       count(*) FILTER (WHERE {_N_DIRTY} > 1) AS n_multi_dirty,
       {', '.join(f"count(*) FILTER (WHERE {_dirty_sql(c)}) AS dirty_{c}" for c in LINE_TYPES)}
FROM lt GROUP BY file"""),
    covers=("AGG-11", "PRJ-7", "FLT-6", "FLT-8"))(dirty_summary)


def dirty_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.dirty_duplicates(_flagged_lines(spark, sf_dir), unit="file", key="l_key")


register("dirty_duplicates", _lines_sql(
    f"""SELECT DISTINCT lt.file, lt.l_key FROM lt
JOIN (SELECT file, l_key FROM lt GROUP BY ALL HAVING count(*) > 1) d ON lt.file = d.file AND lt.l_key = d.l_key
WHERE {_N_DIRTY} > 0"""),
    covers=("AGG-19",))(dirty_duplicates)

# ============================================================== coverage


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled base: the customers whose first order of all is of 1995 or
    earlier, by the minimum over the whole ``orders`` table; label Yes when
    the balance is above 4500."""
    early = (table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.min("o_orderdate").alias("first")).where(F.col("first") < F.lit("1996-01-01").cast("date")))
    c = table(spark, sf_dir, "customer").join(early, "c_custkey", "left_semi")
    return c.select(F.col("c_custkey").alias("entity_id"),
                    F.when(F.col("c_acctbal") > 4500, "Yes").otherwise("No").alias("label"))


_COVERAGE_BASE_SQL = f"""WITH ev AS ({USAGE_EVENTS_SQL}),
act AS (SELECT DISTINCT entity_id, day FROM ev),
lab AS (SELECT c_custkey AS entity_id, CASE WHEN c_acctbal > 4500 THEN 'Yes' ELSE 'No' END AS label
        FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey
                                          HAVING min(o_orderdate) < DATE '1996-01-01')),
bat AS (SELECT DISTINCT entity_id, batch_date FROM ({CUSTOMER_BATCHES_SQL}) b)
"""


def coverage_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = coverage.active_days(staged_events(spark, sf_dir), key="entity_id", day="day")
    return coverage.by_source(active, _labelled(spark, sf_dir), customer_batches(spark, sf_dir),
                              key="entity_id", day="day", label="label")


register("coverage_by_source", _COVERAGE_BASE_SQL + """
SELECT a.day,
  count(DISTINCT CASE WHEN l.label IS NOT NULL THEN a.entity_id END) AS in_base,
  count(DISTINCT CASE WHEN l.label = 'Yes' THEN a.entity_id END) AS label_positive,
  count(DISTINCT CASE WHEN l.label = 'No' THEN a.entity_id END) AS label_negative,
  count(DISTINCT CASE WHEN b.entity_id IS NOT NULL THEN a.entity_id END) AS in_batches,
  count(DISTINCT CASE WHEN l.label IS NULL AND b.entity_id IS NULL THEN a.entity_id END) AS in_neither
FROM act a LEFT JOIN lab l ON a.entity_id = l.entity_id
LEFT JOIN (SELECT DISTINCT entity_id FROM bat) b ON a.entity_id = b.entity_id
GROUP BY a.day""", covers=("JN-5", "AGG-9"))(coverage_by_source)


def coverage_batch_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = coverage.active_days(staged_events(spark, sf_dir), key="entity_id", day="day")
    return coverage.batch_by_day(active, customer_batches(spark, sf_dir), key="entity_id", day="day",
                                 batch="batch_date")


register("coverage_batch_by_day", _COVERAGE_BASE_SQL + """
SELECT b.batch_date, a.day, count(DISTINCT a.entity_id) AS active_members
FROM bat b JOIN act a ON a.entity_id = b.entity_id GROUP BY b.batch_date, a.day""",
         covers=("JN-6", "AGG-10"))(coverage_batch_by_day)
