"""Casting policies, header contracts, quarantine envelope, duplicates,
typing, labels and lineage on small in-memory frames."""

import json

import pytest
from pyspark.sql import functions as F

from trustfold.functions.casting import cast_text, is_dirty, uncastable
from trustfold.operators.contracts import Contract, header_errors
from trustfold.operators.dedup import collapse_identical, split_conflicts
from trustfold.operators.lineage import map_label, stamp
from trustfold.operators.quarantine import LEDGER_COLUMNS, LEDGER_SCHEMA, Run, from_rows
from trustfold.operators.strict_types import split_castable

RUN = Run(run_id="r1", started_at="2026-08-03T10:00:00Z")
TYPES = {"weeks": "int", "fee": "double"}


def _raw(spark, rows):
    return spark.createDataFrame(rows, "id string, weeks string, fee string, _source_file string")


# ---------------------------------------------------------------- casting

@pytest.mark.parametrize("text,legacy,strict", [
    (" 5 ", 5, 5), ("5.7", 5, None), ("5.", 5, None), (".5", 0, None), ("-.", 0, None),
    ("abc", None, None), (" ", None, None), ("", None, None), (None, None, None),
    ("99999999999", None, None), ("+7", 7, 7), ("-3.9", -3, None),
])
def test_int_policies(spark, text, legacy, strict):
    df = spark.createDataFrame([(text,)], "v string")
    row = df.select(cast_text("v", "int", "legacy").alias("l"), cast_text("v", "int", "strict").alias("s")).first()
    assert (row["l"], row["s"]) == (legacy, strict)


def test_double_accepts_java_spellings(spark):
    df = spark.createDataFrame([("1e3",), ("NaN",), ("5d",), (" 2.5 ",), ("x",)], "v string")
    got = [r[0] for r in df.select(cast_text("v", "double")).collect()]
    assert got[0] == 1000.0 and got[2] == 5.0 and got[3] == 2.5 and got[4] is None


def test_uncastable_and_dirty(spark):
    df = spark.createDataFrame([(None,), (" ",), ("abc",), ("3",)], "v string")
    r = df.select(uncastable("v", "int").alias("u"), is_dirty("v", "int").alias("d")).collect()
    assert [x["u"] for x in r] == [False, True, True, False]
    assert [x["d"] for x in r] == [True, True, True, False]


# ---------------------------------------------------------------- headers

def _errors(spark, header, expected):
    df = spark.createDataFrame([("f", header)], "source_file string, header array<string>")
    return [(e["rule"], e["column"]) for e in header_errors(df, expected).first()["errors"]]


def test_header_ok_any_order_case_and_spaces(spark):
    assert _errors(spark, [" WEEKS ", "Id", "fee", "extra"], ["id", "weeks", "fee"]) == []


def test_header_blanks_are_stripped_like_python_strip(spark):
    from trustfold.operators.contracts import column_positions

    header = ["ID\t", "\u3000weeks\u00a0", "fee\r", "\tweeks "]
    # the same normalisation on both sides: Spark finds the repeat, Python the positions
    assert _errors(spark, header, ["id", "weeks", "fee"]) == [("repeated_header", "weeks")]
    assert _errors(spark, header[:3], ["id", "weeks", "fee"]) == []
    assert column_positions(header[:3], ["id", "weeks", "fee"]) == [0, 1, 2]


def test_header_missing_in_contract_order(spark):
    assert _errors(spark, ["fee"], ["id", "weeks", "fee"]) == [
        ("missing_column", "id"), ("missing_column", "weeks")]


def test_header_repeated_once_per_name_first_appearance(spark):
    got = _errors(spark, ["id", "weeks", "WEEKS", " Weeks ", "fee", "id"], ["id", "weeks", "fee"])
    assert got == [("repeated_header", "id"), ("repeated_header", "weeks")]


def test_header_repeated_and_missing_both_reported(spark):
    got = _errors(spark, ["id", "ID"], ["id", "weeks"])
    assert got == [("repeated_header", "id"), ("missing_column", "weeks")]


def test_header_empty_reports_every_column(spark):
    assert _errors(spark, [], ["id", "weeks"]) == [("missing_column", "id"), ("missing_column", "weeks")]


def test_contract_validates_columns():
    with pytest.raises(ValueError):
        Contract(columns=("a", "A"), key="a")
    with pytest.raises(ValueError):
        Contract(columns=("a",), key="b")


# -------------------------------------------------------------- envelope

def test_envelope_schema_and_fixed_values(spark):
    df = _raw(spark, [("c1", None, "x", "file:/d/a.csv")]).withColumn("_batch_id", F.lit("b"))
    q = from_rows(df, "some_rule", RUN, key="id")
    assert q.columns == LEDGER_COLUMNS
    assert [f.dataType for f in q.schema.fields] == [f.dataType for f in LEDGER_SCHEMA.fields]
    r = q.first()
    assert (r.stage, r.rule, r.severity, r.run_id, r.record_key, r.source_file) == (
        "trusted", "some_rule", "blocking", "r1", "c1", "file:/d/a.csv")
    # NULLs kept, lineage columns (leading underscore) left out
    assert json.loads(r.original_record) == {"id": "c1", "weeks": None, "fee": "x"}


# ------------------------------------------------------------- duplicates

def _dedup(spark, rows):
    ok, bad = split_conflicts(_raw(spark, rows), key="id")
    return sorted(map(tuple, ok.collect())), sorted(map(tuple, bad.collect()))


def test_identical_rows_collapse(spark):
    ok, bad = _dedup(spark, [("a", "1", "2", "f1"), ("a", "1", "2", "f1")])
    assert ok == [("a", "1", "2", "f1")] and bad == []


def test_conflict_rejects_every_version(spark):
    ok, bad = _dedup(spark, [("a", "1", "2", "f1"), ("a", "1", "3", "f1"), ("a", "1", "3", "f1"), ("b", "1", "1", "f1")])
    assert ok == [("b", "1", "1", "f1")]
    assert bad == [("a", "1", "2", "f1"), ("a", "1", "3", "f1")]


def test_same_key_other_file_is_a_snapshot(spark):
    ok, bad = _dedup(spark, [("a", "1", "2", "f1"), ("a", "9", "9", "f2")])
    assert len(ok) == 2 and bad == []


def test_null_keys_count_together_per_file(spark):
    ok, bad = _dedup(spark, [(None, "1", "2", "f1"), (None, "2", "2", "f1"), (None, "1", "1", "f2")])
    assert ok == [(None, "1", "1", "f2")]
    assert len(bad) == 2


def test_dedup_is_idempotent(spark):
    rows = [("a", "1", "2", "f1"), ("a", "1", "2", "f1"), ("b", "1", "2", "f1"), ("b", "2", "2", "f1")]
    ok1, _ = split_conflicts(_raw(spark, rows), key="id")
    ok2, bad2 = split_conflicts(ok1, key="id")
    assert sorted(ok1.collect()) == sorted(ok2.collect()) and bad2.count() == 0


def test_folder_unit_collapses_copies_across_part_files(spark):
    df = _raw(spark, [("a", "1", "2", "file:/r/batch=1/p0.csv"), ("a", "1", "2", "file:/r/batch=1/p1.csv"),
                      ("b", "1", "2", "file:/r/batch=1/p0.csv"), ("b", "5", "2", "file:/r/batch=1/p1.csv")])
    assert collapse_identical(df, unit="folder").count() == 3
    ok, bad = split_conflicts(df, key="id", unit="folder")
    assert [r.id for r in ok.collect()] == ["a"] and ok.first()["_source_file"].endswith("p0.csv")
    assert bad.count() == 2


# ----------------------------------------------------------------- typing

def test_typing_ok_rows_typed_and_ordered(spark):
    ok, bad = split_castable(_raw(spark, [("a", " 12 ", "41.25", "f")]), TYPES)
    assert ok.columns == ["id", "weeks", "fee", "_source_file"]
    assert dict(ok.dtypes)["weeks"] == "int" and dict(ok.dtypes)["fee"] == "double"
    assert tuple(ok.first()) == ("a", 12, 41.25, "f") and bad.count() == 0


def test_typing_one_reject_per_failing_column(spark):
    ok, bad = split_castable(_raw(spark, [("a", None, " ", "f"), ("b", "1", "abc", "f"), ("c", "2", "3", "f")]), TYPES)
    assert [r.id for r in ok.collect()] == ["c"]
    rules = sorted((r.id, r._rule) for r in bad.collect())
    assert rules == [("a", "not_numeric_fee"), ("a", "not_numeric_weeks"), ("b", "not_numeric_fee")]
    # the reject keeps the untyped original
    q = from_rows(bad, F.col("_rule"), RUN, key="id").where("record_key = 'b'").first()
    assert json.loads(q.original_record) == {"id": "b", "weeks": "1", "fee": "abc"}


def test_typing_without_typed_columns_keeps_everything(spark):
    ok, bad = split_castable(_raw(spark, [("a", "x", "y", "f")]), {})
    assert ok.count() == 1 and bad.count() == 0


def test_typing_conserves_rows(spark):
    rows = [(str(i), [" ", "1", None, "2.5"][i % 4], ["x", "1.0"][i % 2], "f") for i in range(40)]
    ok, bad = split_castable(_raw(spark, rows), TYPES)
    assert ok.count() + bad.select("id").distinct().count() == 40


# ------------------------------------------------------- labels, lineage

def test_label_map_in_place(spark):
    df = spark.createDataFrame([("a", "Yes"), ("b", "No"), ("c", "maybe")], "id string, label string")
    out = map_label(df, "label")
    assert out.columns == ["id", "label"] and dict(out.dtypes)["label"] == "int"
    assert [r.label for r in out.orderBy("id").collect()] == [1, 0, None]


def test_lineage_one_instant_per_run(spark):
    df = spark.range(50).withColumn("x", F.lit(1))
    out = stamp(df, RUN)
    assert out.columns[-2:] == ["_ingested_at", "_run_id"]
    assert out.select("_ingested_at").distinct().count() == 1
    # the same frame evaluated twice keeps the same instant
    assert out.select("_ingested_at").first()[0] == out.select("_ingested_at").first()[0]


def test_folder_unit_is_the_folder_path_not_its_name(spark):
    rows = [("k", "v1", "/a/batch=1/part-0.csv"), ("k", "v2", "/b/batch=1/part-0.csv"),
            ("j", "same", "/a/batch=1/part-0.csv"), ("j", "same", "/b/batch=1/part-1.csv")]
    df = spark.createDataFrame(rows, "key string, v string, _source_file string")
    ok, bad = split_conflicts(df, key="key", unit="folder")
    # same-named folders under two roots are two batches: no conflict, no collapse
    assert bad.count() == 0 and ok.count() == 4
