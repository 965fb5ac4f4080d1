"""Publishing queries: ledger re-runs, post-publish reports, run summary."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.bindings.order_batches import ALL_BATCHES, TRUST_CTES
from trustfold.bindings.q_features import CUSTOMER_BATCHES_SQL, _gold_sql, customer_batches, gold_profile
from trustfold.bindings.q_trusted import (
    RUN,
    _ROW_REJECTS_SQL,
    _file_rejects_sql,
    _header_errors_sql,
    _typed_select_sql,
    trusted_run,
)
from trustfold.bindings.registry import register
from trustfold.bindings.usage import USAGE_METRICS, USAGE_RATIOS, WEEKLY_AS_OF, staged_events, table
from trustfold.operators.contracts import Contract
from trustfold.operators.quarantine import Run
from trustfold.operators.report import profile_summary, rejected_values, rule_counts, table_counts
from trustfold.plans.batch import Source, run_batch
from trustfold.session import scratch_path
from trustfold.sinks.tables import publish_ledger, read_ledger, read_table, replace_table

RUN_A = Run(run_id="run-A", started_at="2026-08-03T06:00:00Z")
RUN_B = Run(run_id="run-B", started_at="2026-08-10T06:00:00Z")
RUN_B_AGAIN = Run(run_id="run-B", started_at="2026-08-10T09:30:00Z")
BATCHES_A = [b for b in ALL_BATCHES if b <= "1999"]
BATCHES_B = [b for b in ALL_BATCHES if b > "1999"]


RUN_C = Run(run_id="run-C", started_at="2026-08-17T06:00:00Z")
_ledger_lock = threading.Lock()
_ledgers: dict[tuple[str, str], str] = {}


def published_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish run A, run B, run B again (a retry), and run C, which a
    corrected second attempt leaves without any reject; once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _ledger_lock:
        if key not in _ledgers:
            path = scratch_path(spark, "ledger")
            for run, batches in ((RUN_A, BATCHES_A), (RUN_B, BATCHES_B), (RUN_B_AGAIN, BATCHES_B)):
                publish_ledger(trusted_run(spark, sf_dir, run, batches).quarantine, path, run_id=run.run_id)
            first = read_ledger(spark, path).where(F.col("run_id") == RUN_A.run_id)
            wrong = first.withColumns({"run_id": F.lit(RUN_C.run_id), "original_record": F.to_json("original_record")})
            publish_ledger(wrong, path, run_id=RUN_C.run_id)
            publish_ledger(wrong.limit(0), path, run_id=RUN_C.run_id)
            _ledgers[key] = path
        return read_ledger(spark, _ledgers[key])


_ALL_REJECTS_SQL = f"""{TRUST_CTES},
rej AS ({_ROW_REJECTS_SQL}
        UNION ALL {_file_rejects_sql()})"""


def ledger_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows per (stage, run, rule) after a retried and a corrected run:
    the retry replaced its slice (no doubled rows, its timestamp), the
    corrected run left nothing, the other run is untouched, and the record is
    typed JSON."""
    led = published_ledger(spark, sf_dir)
    return led.groupBy("stage", "run_id", "rule").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("original_record").alias("n_records"),
        F.max(F.unix_seconds("rejected_at")).alias("rejected_at"),
    )


register(
    "ledger_rerun",
    f"""{_ALL_REJECTS_SQL}
SELECT '{RUN.stage}' AS stage, CASE WHEN batch <= '1999' THEN 'run-A' ELSE 'run-B' END AS run_id, rule,
       count(*) AS n_rows, count(original_record) AS n_records,
       max(CASE WHEN batch <= '1999' THEN CAST(epoch(TIMESTAMP '2026-08-03 06:00:00') AS BIGINT)
                ELSE CAST(epoch(TIMESTAMP '2026-08-10 09:30:00') AS BIGINT) END) AS rejected_at
FROM rej GROUP BY ALL""",
    covers=("SNK-3", "SNK-4", "SNK-5", "Q-19"),
)(ledger_rerun)


def ledger_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts(published_ledger(spark, sf_dir))


register("ledger_rule_counts", f"{_ALL_REJECTS_SQL}\nSELECT rule, count(*) AS n_rows FROM rej GROUP BY rule",
         covers=("SNK-6", "SRT-2"))(ledger_rule_counts)


def ledger_rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rejected records hold, read back out of the published VARIANT:
    the failing value per typing rule, the two sides of a conflict, the names
    of a rejected header."""
    fields = {"not_numeric_o_custkey": ("o_custkey",), "not_numeric_o_totalprice": ("o_totalprice", "o_orderstatus"),
              "conflicting_duplicate_key": ("o_orderpriority", "batch_date")}
    return rejected_values(published_ledger(spark, sf_dir), fields, {"missing_column": "header", "repeated_header": "header"})


def _values_sql() -> str:
    picked = [("conflict", "conflicting_duplicate_key", "o_orderpriority", ""), ("conflict", "conflicting_duplicate_key", "batch_date", ""),
              ("single", "not_numeric_o_custkey", "o_custkey", "WHERE TRY_CAST(o_custkey AS INTEGER) IS NULL"),
              ("single", "not_numeric_o_totalprice", "o_totalprice", "WHERE TRY_CAST(o_totalprice AS DOUBLE) IS NULL"),
              ("single", "not_numeric_o_totalprice", "o_orderstatus", "WHERE TRY_CAST(o_totalprice AS DOUBLE) IS NULL")]
    parts = [f"SELECT '{rule}' AS rule, '{column}' AS column_name, {column} AS value FROM {source} {where}" for source, rule, column, where in picked]
    headers = f"SELECT rule, 'header' AS column_name, unnest(CAST(json_extract(original_record, '$.header') AS VARCHAR[])) AS value FROM ({_header_errors_sql()}) h"
    return " UNION ALL ".join([*parts, headers])


register(
    "ledger_rejected_values",
    f"""{TRUST_CTES}
SELECT rule, column_name, value, count(*) AS n_rows, count(TRY_CAST(value AS DOUBLE)) AS n_numbers
FROM ({_values_sql()}) v GROUP BY rule, column_name, value""",
    covers=("SNK-5", "fn: json"),
)(ledger_rejected_values)


def publish_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and ledger after publishes that went wrong: a table whose re-run
    fails half-way keeps its rows, a ledger slice whose re-run fails keeps
    its rows, and of two runs published at the same time both stand."""
    table_path, ledger_path = scratch_path(spark, "recovery"), scratch_path(spark, "recovery_ledger")
    rows = customer_batches(spark, sf_dir)
    replace_table(rows, table_path)
    broken = rows.withColumn("c_name", F.when(F.col("entity_id") % 10 == 0, F.raise_error(F.lit(_BROKEN))).otherwise(F.col("c_name")))
    _must_fail(lambda: replace_table(broken, table_path))

    led = published_ledger(spark, sf_dir).withColumn("original_record", F.to_json("original_record"))
    run_a, run_b = (led.where(F.col("run_id") == r.run_id) for r in (RUN_A, RUN_B))
    publish_ledger(run_a, ledger_path, run_id=RUN_A.run_id)
    half = run_a.withColumn("rule", F.when(F.col("rule") == "conflicting_duplicate_key", F.raise_error(F.lit(_BROKEN))).otherwise(F.col("rule")))
    _must_fail(lambda: publish_ledger(half, ledger_path, run_id=RUN_A.run_id))
    with ThreadPoolExecutor(2) as both:
        for done in [both.submit(publish_ledger, run_a, ledger_path, run_id=RUN_A.run_id),
                     both.submit(publish_ledger, run_b, ledger_path, run_id=RUN_B.run_id)]:
            done.result()
    counts = table_counts({"table": read_table(spark, table_path)}).select(F.col("table_name").alias("name"), "n_rows")
    for r in (RUN_A, RUN_B):
        counts = counts.union(read_ledger(spark, ledger_path, run_id=r.run_id).agg(F.lit(r.run_id), F.count(F.lit(1))))
    return counts


_BROKEN = "a publish that fails half-way"


def _must_fail(publish) -> None:
    try:
        publish()
    except Exception as e:
        if _BROKEN not in str(e):
            raise
    else:
        raise RuntimeError("a publish with a failing row was committed")


register(
    "publish_recovery",
    f"""{_ALL_REJECTS_SQL}
SELECT 'table' AS name, count(*) AS n_rows FROM ({CUSTOMER_BATCHES_SQL}) b
UNION ALL SELECT 'run-A', count(*) FROM rej WHERE batch <= '1999'
UNION ALL SELECT 'run-B', count(*) FROM rej WHERE batch > '1999'""",
    covers=("SNK-1", "SNK-2", "SNK-4"),
)(publish_recovery)


def table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish trusted rows, quarantine and gold with full replace (twice, to
    show the re-run does not append), re-read them and count."""
    out = trusted_run(spark, sf_dir)
    root = scratch_path(spark, "published")
    frames = {"trusted": out.trusted, "quarantine": out.quarantine, "gold": gold_profile(spark, sf_dir)}
    for _ in range(2):
        for name, df in frames.items():
            replace_table(df, f"{root}/{name}")
    return table_counts({n: read_table(spark, f"{root}/{n}") for n in frames})


register(
    "table_sizes",
    f"""{_ALL_REJECTS_SQL}
SELECT 'trusted' AS table_name, count(*) AS n_rows FROM ({_typed_select_sql('single')}) x
UNION ALL SELECT 'quarantine', count(*) FROM rej
UNION ALL SELECT 'gold', count(*) FROM ({CUSTOMER_BATCHES_SQL}) b""",
    covers=("SNK-1", "SNK-2", "SNK-7", "SET-3", "SRC-5"),
)(table_sizes)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the published gold table, read back from its files (the
    event scan is not repeated for the summary)."""
    path = scratch_path(spark, "gold")
    replace_table(gold_profile(spark, sf_dir), path)
    return profile_summary(read_table(spark, path), "n_calls", "gold")


register(
    "run_summary",
    f"""SELECT 'gold' AS table_name, count(*) AS n_rows, CAST(sum(n_calls) AS BIGINT) AS sum_n_calls,
       count(*) FILTER (WHERE n_calls = 0) AS zero_n_calls
FROM ({_gold_sql(CUSTOMER_BATCHES_SQL, "CAST(batch_date AS DATE)", 14)}) g""",
    covers=("SNK-8",),
)(run_summary)

# ------------------------------------------------------------ whole batch run

WEEKLY_CONTRACT = Contract(
    columns=("entity_id", "c_name", "c_mktsegment", "c_acctbal", "batch_date"),
    key="entity_id",
    types={"entity_id": "bigint", "c_acctbal": "double"},
)
BASE_CONTRACT = Contract(columns=("entity_id", "c_name", "c_acctbal", "label"), key="entity_id",
                         types={"entity_id": "bigint", "c_acctbal": "double"}, label="label")
BASE_AS_OF = "2024-01-29"
RUN_DAYS = 14
_weekly_lock = threading.Lock()
_weekly: dict[tuple[str, str], tuple[list[str], list[str]]] = {}


def staged_weekly_batches(spark: SparkSession, sf_dir: str) -> tuple[list[str], list[str]]:
    """The two raw sources of a run as CSV, once per session: weekly batches
    (one folder per date, in a folder whose name has pattern characters) and
    the labelled base (deflate compressed).

    Derived dirt: an unreadable balance (weekly key % 29 = 0, base key % 23 =
    0), a second version of the row (weekly key % 31 = 0), an identical copy
    (weekly key % 37 = 0)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _weekly_lock:
        if key not in _weekly:
            root = scratch_path(spark, "weekly_batches") + "/drop[1]"
            k = F.col("entity_id")
            rows = customer_batches(spark, sf_dir).withColumn("copies", F.explode(F.array_compact(F.array(
                F.lit("row"), F.when(k % 31 == 0, F.lit("version")), F.when(k % 37 == 0, F.lit("copy"))))))
            rows = rows.withColumns({
                "c_name": F.when(F.col("copies") == "version", F.concat("c_name", F.lit(" II"))).otherwise(F.col("c_name")),
                "c_acctbal": F.when(k % 29 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))})
            text = rows.select(*[F.col(c).cast("string").alias(c) for c in WEEKLY_CONTRACT.columns], F.col("batch_date").alias("week"))
            text.write.partitionBy("week").option("header", True).csv(root)
            base = scratch_path(spark, "labelled_base")
            (table(spark, sf_dir, "customer")
             .select(F.col("c_custkey").cast("string").alias("entity_id"), "c_name",
                     F.when(F.col("c_custkey") % 23 == 0, F.lit("unknown")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
                     F.when(F.col("c_acctbal") > 4500, "Yes").otherwise("No").alias("label"))
             .write.option("header", True).option("compression", "deflate").csv(base))
            _weekly[key] = [f"{root}/week={d}" for d in WEEKLY_AS_OF], [base]
        return _weekly[key]


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch run in one call: the labelled base (literal as-of date)
    and the weekly CSV batches through the trust stage, the ledger slice, and
    gold with 14 days of usage from the written trusted tables.  Rows: counts
    of the written tables, sums of the gold metrics, rejects per rule."""
    weekly, base = staged_weekly_batches(spark, sf_dir)
    sources = {"base": Source(tuple(base), BASE_CONTRACT, unit="folder", as_of_date=BASE_AS_OF),
               "weekly": Source(tuple(weekly), WEEKLY_CONTRACT, unit="folder", as_of_column="batch_date")}
    out = run_batch(spark, sources, staged_events(spark, sf_dir), scratch_path(spark, "batch_run"),
                    Run(run_id="run-weekly", started_at="2026-08-31T06:00:00Z"), metrics=USAGE_METRICS,
                    ratios=USAGE_RATIOS, horizon_days=RUN_DAYS)
    sums = [m.name for m in USAGE_METRICS]
    parts = [out.summary.select(F.lit("rows").alias("part"), F.col("table_name").alias("name"), F.col("n_rows").cast("double").alias("value")),
             out.rejects.select(F.lit("rejects"), "rule", F.col("n_rows").cast("double"))]
    for source, path in out.gold.items():
        totals = read_table(spark, path).agg(*[F.sum(m).cast("double").alias(m) for m in sums])
        parts.append(totals.select(F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("v")) for m in sums])).alias("x"))
                     .select(F.lit(f"gold_{source}"), "x.m", "x.v"))
    result = parts[0]
    for p in parts[1:]:
        result = result.union(p)
    return result


_WEEKLY_OK = f"SELECT * FROM ({CUSTOMER_BATCHES_SQL}) b WHERE entity_id % 31 <> 0 AND entity_id % 29 <> 0"
_BASE_OK = f"SELECT c_custkey AS entity_id, c_name, '' AS c_mktsegment, c_acctbal, '{BASE_AS_OF}' AS batch_date FROM customer WHERE c_custkey % 23 <> 0"


def _gold_sums(name: str, rows: str) -> str:
    gold = _gold_sql(rows, "CAST(batch_date AS DATE)", RUN_DAYS)
    return " UNION ALL ".join(f"SELECT 'gold_{name}' AS part, '{m.name}' AS name, CAST(sum({m.name}) AS DOUBLE) AS value FROM ({gold}) g"
                              for m in USAGE_METRICS)


register(
    "batch_run",
    f"""WITH w AS ({CUSTOMER_BATCHES_SQL}),
rej AS (SELECT 'conflicting_duplicate_key' AS rule FROM w, (VALUES (1), (2)) v(i) WHERE entity_id % 31 = 0
        UNION ALL SELECT 'not_numeric_c_acctbal' FROM w WHERE entity_id % 29 = 0 AND entity_id % 31 <> 0
        UNION ALL SELECT 'not_numeric_c_acctbal' FROM customer WHERE c_custkey % 23 = 0)
SELECT 'rows' AS part, 'trusted_weekly' AS name, CAST(count(*) AS DOUBLE) AS value FROM ({_WEEKLY_OK}) t
UNION ALL SELECT 'rows', 'gold_weekly', CAST(count(*) AS DOUBLE) FROM ({_WEEKLY_OK}) t
UNION ALL SELECT 'rows', 'trusted_base', CAST(count(*) AS DOUBLE) FROM ({_BASE_OK}) t
UNION ALL SELECT 'rows', 'gold_base', CAST(count(*) AS DOUBLE) FROM ({_BASE_OK}) t
UNION ALL SELECT 'rows', 'quarantine', CAST(count(*) AS DOUBLE) FROM rej
UNION ALL SELECT 'rejects', rule, CAST(count(*) AS DOUBLE) FROM rej GROUP BY rule
UNION ALL {_gold_sums("weekly", _WEEKLY_OK)}
UNION ALL {_gold_sums("base", _BASE_OK)}""",
    covers=("VAL-15", "JN-3", "SNK-1", "SNK-4", "SNK-6", "SNK-7", "SRC-1", "SRC-2", "SRC-5"),
)(batch_run)
