"""A whole batch run: two sources through trust, ledger and gold, re-run safely."""

from datetime import date

from trustfold.operators.contracts import Contract
from trustfold.operators.features import Metric
from trustfold.operators.quarantine import Run
from trustfold.plans.batch import Source, run_batch
from trustfold.sinks.tables import read_ledger, read_table

BASE = Contract(columns=("id", "tenure", "label"), key="id", types={"tenure": "int"}, label="label")
WEEKLY = Contract(columns=("id", "tenure", "batch_date"), key="id", types={"tenure": "int"})
METRICS = [Metric("n_calls", "count", when="kind = 'call'")]


def test_run_batch_end_to_end_and_rerun(spark, tmp_path):
    base = tmp_path / "base.csv"
    base.write_text("id,tenure,label\na,1,Yes\nb,x,No\nc,3,No\n")
    w1 = tmp_path / "w_2026-08-03.csv"
    w1.write_text("batch_date,id,tenure\n2026-08-03,a,2\n2026-08-03,a,2\n2026-08-03,d,5\n")
    w2 = tmp_path / "w_2026-08-10.csv"
    w2.write_text("id,TENURE\na,3\n")  # missing batch_date: the whole file is rejected
    events = spark.createDataFrame(
        [("a", "call", date(2026, 8, 1)), ("a", "call", date(2026, 7, 20)), ("d", "call", date(2026, 8, 2)),
         ("c", "data", date(2026, 8, 1))], "id string, kind string, day date")
    sources = {
        "base": Source((str(base),), BASE, as_of_date="2026-08-03"),
        "weekly": Source((str(w1), str(w2)), WEEKLY, as_of_column="batch_date"),
    }
    run = Run("run-1", "2026-08-04T06:00:00Z")
    for _ in range(2):  # a re-run replaces, never appends
        out = run_batch(spark, sources, events, str(tmp_path / "out"), run, metrics=METRICS, horizon_days=7,
                        summary_metric="n_calls")
        counts = {r.table_name: r.n_rows for r in out.summary.collect()}
        assert counts == {"trusted_base": 2, "trusted_weekly": 2, "gold_base": 2, "gold_weekly": 2,
                          "quarantine": 2}
    gold = {r.id: r.n_calls for r in read_table(spark, out.gold["weekly"]).collect()}
    assert gold == {"a": 1, "d": 1}  # the 2026-07-20 call is outside the 7-day window
    base_gold = read_table(spark, out.gold["base"])
    assert base_gold.columns[:2] == ["id", "as_of"] and "label" in base_gold.columns
    rules = sorted(r.rule for r in read_ledger(spark, out.ledger).collect())
    assert rules == ["missing_column", "not_numeric_tenure"]
    totals = out.gold_totals["weekly"].first()
    assert (totals.n_rows, totals.sum_n_calls, totals.zero_n_calls) == (2, 2, 0)


def test_clean_run_has_an_empty_quarantine(spark, tmp_path):
    w = tmp_path / "w.csv"
    w.write_text("id,tenure,batch_date\na,1,2026-08-03\n")
    events = spark.createDataFrame([("a", "call", date(2026, 8, 1))], "id string, kind string, day date")
    out = run_batch(spark, {"weekly": Source((str(w),), WEEKLY, as_of_column="batch_date")}, events,
                    str(tmp_path / "out"), Run("run-c", "2026-08-04T06:00:00Z"), metrics=METRICS, horizon_days=7)
    counts = {r.table_name: r.n_rows for r in out.summary.collect()}
    assert counts == {"trusted_weekly": 1, "gold_weekly": 1, "quarantine": 0}
