"""Publishing (ledger slices, table replace), reports, profiling, coverage,
and the driver contract."""

import json
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustfold.operators import coverage, profile
from trustfold.operators.quarantine import Run, from_rows
from trustfold.operators.report import reconcile, rule_counts, table_counts
from trustfold.sinks.tables import check_not_null, clear_run, publish_ledger, read_ledger, read_table, replace_table


def _rejects(spark, run, n, rule="r1"):
    df = spark.createDataFrame([(str(i), "x", f"f{i % 2}") for i in range(n)], "id string, v string, _source_file string")
    return from_rows(df, rule, run, key="id")


def test_ledger_rerun_replaces_only_its_slice(spark, tmp_path):
    path = str(tmp_path / "ledger")
    a, b = Run("A", "2026-08-03T00:00:00Z"), Run("B", "2026-08-10T00:00:00Z")
    publish_ledger(_rejects(spark, a, 3), path)
    publish_ledger(_rejects(spark, b, 5), path)
    publish_ledger(_rejects(spark, Run("B", "2026-08-10T05:00:00Z"), 4, "r2"), path)
    led = read_ledger(spark, path)
    got = sorted((r.run_id, r.rule, r.n) for r in led.groupBy("run_id", "rule").agg(F.count("*").alias("n")).collect())
    assert got == [("A", "r1", 3), ("B", "r2", 4)]
    assert dict(led.dtypes)["original_record"] == "variant"
    # without a run id an empty publish leaves the ledger untouched; with it the run's slice is cleared
    publish_ledger(_rejects(spark, b, 0), path)
    assert read_ledger(spark, path).count() == 7
    publish_ledger(_rejects(spark, b, 0), path, run_id="B")
    assert [r.run_id for r in read_ledger(spark, path).select("run_id").distinct().collect()] == ["A"]


def test_run_ids_with_odd_characters_and_stages_no_longer_written(spark, tmp_path):
    path = str(tmp_path / "ledger")
    odd, other = Run("2026/08:31 a=b%", "2026-08-03T00:00:00Z"), Run("B", "2026-08-03T00:00:00Z")
    two = _rejects(spark, odd, 2).unionByName(_rejects(spark, odd, 3).withColumn("stage", F.lit("typing")))
    publish_ledger(two, path, run_id=odd.run_id)
    publish_ledger(_rejects(spark, other, 4), path, run_id="B")
    publish_ledger(_rejects(spark, odd, 1), path, run_id=odd.run_id)
    got = {(r.run_id, r.stage): r["count"] for r in read_ledger(spark, path).groupBy("run_id", "stage").count().collect()}
    assert sorted(got.values()) == [1, 4] and clear_run(spark, path, odd.run_id) == 1
    assert read_ledger(spark, path).count() == 4 and clear_run(spark, str(tmp_path / "none"), "B") == 0


def test_not_null_check_refuses_bad_slice(spark):
    bad = _rejects(spark, Run("A", "2026-08-03T00:00:00Z"), 2).withColumn("rule", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="rule"):
        check_not_null(bad)


def test_null_in_not_null_column_fails_publish_and_keeps_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    run = Run("A", "2026-08-03T00:00:00Z")
    publish_ledger(_rejects(spark, run, 3), path)
    bad = _rejects(spark, run, 2).withColumn("rule", F.when(F.col("record_key") == "1", None).otherwise(F.col("rule")))
    with pytest.raises(Exception, match="NOT NULL: rule"):
        publish_ledger(bad, path)
    assert read_ledger(spark, path).count() == 3


def test_invalid_json_fails_publish(spark, tmp_path):
    bad = _rejects(spark, Run("A", "2026-08-03T00:00:00Z"), 1).withColumn("original_record", F.lit("{oops"))
    with pytest.raises(Exception):
        publish_ledger(bad, str(tmp_path / "l"))


def test_replace_table_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        replace_table(spark.range(10), path, files=2)
    assert read_table(spark, path).count() == 10


def test_reports(spark):
    led = _rejects(spark, Run("A", "2026-08-03T00:00:00Z"), 3).unionByName(
        _rejects(spark, Run("A", "2026-08-03T00:00:00Z"), 5, "r2"))
    assert [(r.rule, r.n_rows) for r in rule_counts(led).collect()] == [("r2", 5), ("r1", 3)]
    tc = {r.table_name: r.n_rows for r in table_counts({"x": spark.range(4), "y": spark.range(0)}).collect()}
    assert tc == {"x": 4, "y": 0}


def test_reconcile_balances(spark):
    raw = spark.createDataFrame([("b", "1"), ("b", "1"), ("b", "2"), ("b", "3")], "batch string, k string")
    tagged = raw.distinct()
    trusted = spark.createDataFrame([("b", "1")], "batch string, k string")
    rejects = spark.createDataFrame([("b", "{2}"), ("b", "{2}"), ("b", "{3}")], "batch string, original_record string")
    r = reconcile(raw=raw, tagged=tagged, trusted=trusted, rejects=rejects, by="batch").first()
    assert (r.raw_rows, r.trusted_rows, r.rejected_records, r.collapsed_copies, r.balance) == (4, 1, 2, 1, 0)


# ---------------------------------------------------------------- profile

def test_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(100, 15, 5000).round(2)
    df = spark.createDataFrame([(str(v),) for v in vals] + [("abc",), (None,)], "x string")
    q = profile.numeric_quantiles(df, {"x": "double"}).first().quantiles
    exact = np.quantile(vals, [0.25, 0.5, 0.75])
    # rank error of the sketch is at most n / accuracy = 0.5 rank -> value within one neighbour
    srt = np.sort(vals)
    for got, want in zip(q, exact):
        rank = np.searchsorted(srt, got)
        assert abs(rank - np.searchsorted(srt, want)) <= 2


def test_top_values_ties_broken_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"], "c string")
    got = [(r.value, r.n_rows, r.rank) for r in profile.top_values_per_column(df, ["c", "missing"], k=3).orderBy("rank").collect()]
    assert got == [("a", 2, 1), ("b", 2, 2), ("c", 2, 3)]


def test_uncastable_examples_deterministic(spark):
    vals = ["1", "x", "y", " ", "z", "w", "v", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    r = profile.uncastable_values(df, {"c": "int"}, examples=3).first()
    assert r.n_uncastable == 7 and list(r.examples) == [" ", "v", "w"]


def test_dirty_flags_and_duplicate_kind(spark):
    df = spark.createDataFrame(
        [("f", "a", "1"), ("f", "a", "1"), ("f", "b", None), ("f", "b", None), ("f", "c", "x"), ("f", "c", "2"),
         ("g", "a", "1")], "file string, k string, v string")
    flagged = profile.dirty_flags(df, {"v": "double"})
    s = profile.dirty_summary(flagged, "file", {"v": "double"}).where("file = 'f'").first()
    assert (s.n_rows, s.n_dirty_rows, s.dirty_v) == (6, 3, 3)
    kinds = {r.k: (r.n_rows, r.n_versions, r.identical)
             for r in profile.duplicate_kind(df, unit="file", key="k", cols=["k", "v"]).collect()}
    # identical copies holding a NULL are still "identical"
    assert kinds == {"a": (2, 1, True), "b": (2, 1, True), "c": (2, 2, False)}
    assert {r.k for r in profile.dirty_duplicates(flagged, unit="file", key="k").collect()} == {"b", "c"}
    assert [r.k for r in profile.keys_across_units(df, unit="file", key="k").collect()] == ["a"]


def test_coverage(spark):
    active = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 1)), (3, date(2024, 1, 1)),
                                    (1, date(2024, 1, 2))], "e int, day date")
    lab = spark.createDataFrame([(1, "Yes"), (2, "No")], "e int, label string")
    bat = spark.createDataFrame([(1, "w1"), (1, "w2"), (3, "w1")], "e int, batch string")
    r = {x.day: x for x in coverage.by_source(active, lab, bat, key="e", day="day", label="label").collect()}
    d1 = r[date(2024, 1, 1)]
    assert (d1.in_base, d1.label_positive, d1.label_negative, d1.in_batches, d1.in_neither) == (2, 1, 1, 2, 0)
    bd = {(x.batch, x.day): x.active_members
          for x in coverage.batch_by_day(active, bat, key="e", day="day", batch="batch").collect()}
    assert bd == {("w1", date(2024, 1, 1)): 2, ("w1", date(2024, 1, 2)): 1, ("w2", date(2024, 1, 1)): 1,
                  ("w2", date(2024, 1, 2)): 1}


# ---------------------------------------------------------------- driver

def test_driver_contract(spark):
    import __spark_entry__ as ent

    qs, sqls = ent.queries(), ent.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 40
    df = ent.entry(spark)
    assert df.count() > 0 and "n_calls" in df.columns


def test_oracle_matches_on_smoke_data(spark):
    """A few queries against DuckDB on the smallest tables (the driver runs all)."""
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as ent

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ["customer", "events", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ["pit_usage_fixed", "trusted_silver", "dedup_conflicts"]:
        df = ent.queries()[name](spark, sf)
        got = sorted(json.dumps([str(x) for x in r], sort_keys=True) for r in df.select(sorted(df.columns)).collect())
        cur = con.execute(ent.oracle_sql()[name])
        cols = [d[0] for d in cur.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted(json.dumps([str(r[i]) for i in order], sort_keys=True) for r in cur.fetchall())
        assert len(got) == len(want), name
        assert got == want, name


def test_oracle_matches_under_another_session_time_zone(spark):
    """The driver's session may not run in UTC: results must not depend on it."""
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as ent

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ["customer", "events", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ["lineage_stamp", "daily_activity", "pit_usage_by_batch", "typed_ok"]:
            df = ent.queries()[name](spark, sf)
            got = sorted(json.dumps([str(x) for x in r]) for r in df.select(sorted(df.columns)).collect())
            cur = con.execute(ent.oracle_sql()[name])
            cols = [d[0] for d in cur.description]
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            want = sorted(json.dumps([str(r[i]) for i in order]) for r in cur.fetchall())
            assert got == want, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
