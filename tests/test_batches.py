"""Raw CSV batches end to end: headers, reading by name, routing, trust stage."""

import json

from pyspark.sql import functions as F

from trustfold.operators.contracts import Contract
from trustfold.operators.quarantine import LEDGER_COLUMNS, Run
from trustfold.plans.trusted import build_trusted, read_accepted, route_files
from trustfold.sources.batches import batch_paths, read_headers

CONTRACT = Contract(columns=("id", "tenure", "charges"), key="id", types={"tenure": "int", "charges": "double"})
LABELLED = Contract(columns=("id", "tenure", "charges", "label"), key="id",
                    types={"tenure": "int", "charges": "double"}, label="label")
RUN = Run(run_id="run-t", started_at="2026-08-03T10:00:00Z")


def _write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def _run(spark, tmp_path, files, contract=CONTRACT):
    paths = [_write(tmp_path / name, body) for name, body in files.items()]
    return build_trusted(spark, paths, contract, RUN, scratch=str(tmp_path / "tagged"))


def test_batch_paths_are_explicit():
    assert batch_paths("/b/", ["2026-08-03", " 2026-08-10 ", ""], "{root}/c_{batch}.csv") == [
        "/b/c_2026-08-03.csv", "/b/c_2026-08-10.csv"]


def test_headers_exact_names_quotes_bom_and_empty_file(spark, tmp_path):
    a = _write(tmp_path / "a.csv", '﻿"id", Tenure ,"a,b"\n1,2,3\n')
    b = _write(tmp_path / "b.csv", "")
    c = _write(tmp_path / "c.csv", "x\r\n1\r\n")
    got = {r.source_file.rsplit("/", 1)[1]: list(r.header) for r in read_headers(spark, [a, b, c]).collect()}
    assert got == {"a.csv": ["id", " Tenure ", "a,b"], "b.csv": [], "c.csv": ["x"]}


def test_reads_by_name_not_position_and_drops_extras(spark, tmp_path):
    out = _run(spark, tmp_path, {
        "a.csv": "id,tenure,charges\na,1,2.5\n",
        "b.csv": "charges, TENURE ,extra,ID\n3.5,7,zzz,b\n",
    })
    rows = sorted((r.id, r.tenure, r.charges) for r in out.trusted.collect())
    assert rows == [("a", 1, 2.5), ("b", 7, 3.5)]
    assert out.trusted.columns == ["id", "tenure", "charges", "_source_file", "_ingested_at", "_run_id"]


def test_empty_cell_is_null_space_is_kept(spark, tmp_path):
    out = _run(spark, tmp_path, {"a.csv": "id,tenure,charges\na,,1\nb, ,1\n"})
    recs = {r.record_key: json.loads(r.original_record) for r in out.quarantine.collect()}
    assert recs["a"]["tenure"] is None and recs["b"]["tenure"] == " "


def test_bad_header_rejects_whole_file_and_keeps_exact_names(spark, tmp_path):
    out = _run(spark, tmp_path, {
        "good.csv": "id,tenure,charges\na,1,2\n",
        "bad.csv": "CustomerID,tenure,TENURE\nz,1,1\n",
    })
    assert [r.id for r in out.trusted.collect()] == ["a"]
    q = out.quarantine.collect()
    assert sorted(r.rule for r in q) == ["missing_column", "missing_column", "repeated_header"]
    assert {r.record_key for r in q} == {None}
    assert all(r.source_file.endswith("bad.csv") for r in q)
    assert json.loads(q[0].original_record) == {"header": ["CustomerID", "tenure", "TENURE"]}
    assert out.quarantine.columns == LEDGER_COLUMNS


def test_missing_column_never_shifts_other_files(spark, tmp_path):
    out = _run(spark, tmp_path, {
        "a.csv": "id,charges\nx,9\n",
        "b.csv": "id,tenure,charges\ny,1,2\n",
    })
    assert [(r.id, r.tenure, r.charges) for r in out.trusted.collect()] == [("y", 1, 2.0)]


def test_no_valid_file_gives_empty_trusted_with_schema(spark, tmp_path):
    out = _run(spark, tmp_path, {"a.csv": "", "b.csv": "foo\n1\n"})
    assert out.trusted.count() == 0
    assert out.trusted.columns[:3] == ["id", "tenure", "charges"]
    assert out.quarantine.where("rule = 'missing_column'").count() == 6


def test_same_key_in_two_files_kept(spark, tmp_path):
    out = _run(spark, tmp_path, {"a.csv": "id,tenure,charges\nk,1,1\n", "b.csv": "id,tenure,charges\nk,2,2\n"})
    assert out.trusted.count() == 2 and out.quarantine.count() == 0


def test_conflict_reported_only_as_conflict(spark, tmp_path):
    out = _run(spark, tmp_path, {"a.csv": "id,tenure,charges\nk,1,abc\nk,2,abc\nm,1,1\nm,1,1\n"})
    assert sorted(r.rule for r in out.quarantine.collect()) == ["conflicting_duplicate_key"] * 2
    assert [r.id for r in out.trusted.collect()] == ["m"]


def test_label_binarised_and_one_timestamp_for_both_outputs(spark, tmp_path):
    out = _run(spark, tmp_path, {"a.csv": "id,tenure,charges,label\na,1,1,Yes\nb,1,1,No\nc,x,1,Yes\n"},
               contract=LABELLED)
    assert sorted((r.id, r.label) for r in out.trusted.collect()) == [("a", 1), ("b", 0)]
    ts = {r[0] for r in out.trusted.select("_ingested_at").collect()} | {
        r[0] for r in out.quarantine.select("rejected_at").collect()}
    assert len(ts) == 1


def test_row_conservation(spark, tmp_path):
    body = "id,tenure,charges\n" + "".join(
        f"{i % 17},{[' ', '1', '', 'x'][i % 4]},{['1', 'n/a'][i % 3 == 0]}\n" for i in range(60))
    out = _run(spark, tmp_path, {"a.csv": body})
    raw = 60
    distinct = out.tagged.count()
    rejected = out.quarantine.select("source_file", "original_record").distinct().count()
    assert raw == out.trusted.count() + rejected + (raw - distinct)


def test_path_with_space(spark, tmp_path):
    d = tmp_path / "sp ace"
    d.mkdir()
    out = build_trusted(spark, [_write(d / "a.csv", "id,tenure,charges\na,1,1\n")], CONTRACT, RUN,
                        scratch=str(tmp_path / "tagged"))
    assert out.trusted.count() == 1
    assert out.trusted.select(F.col("_source_file")).first()[0].endswith("a.csv")


def test_first_lines_of_odd_files(spark, tmp_path):
    (tmp_path / "sp ace").mkdir()
    files = [
        _write(tmp_path / "sp ace" / "a.csv", '\ufeff"id", Tenure ,"a,b"\r\n1,2,3\r\n'),
        _write(tmp_path / "b.csv", ""),
        _write(tmp_path / "c.csv", "\nid,x\n"),
        _write(tmp_path / "d.csv", "id,x"),
    ]
    got = {r.source_file.rsplit("/", 1)[1]: list(r.header) for r in read_headers(spark, files).collect()}
    assert got == {"a.csv": ["id", " Tenure ", "a,b"], "b.csv": [], "c.csv": [], "d.csv": ["id", "x"]}


def test_names_with_pattern_characters_are_read_literally(spark, tmp_path):
    body = "id,tenure,charges\n"
    names = ["a[1].csv", "a1.csv", "b{x,y}.csv", "bx.csv", "c*.csv", "cc.csv", "d?.csv", "de.csv"]
    out = _run(spark, tmp_path, {n: body + f"k{i},1,1\n" + (f"m{i},2,2\n" if i % 2 == 0 else "") for i, n in enumerate(names)})
    assert sorted(r.id for r in out.trusted.collect()) == sorted([f"k{i}" for i in range(8)] + [f"m{i}" for i in range(0, 8, 2)])
    assert out.quarantine.count() == 0


def test_codecs_of_spark(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", "2.5"), ("b", "2", "3.5")], "id string, tenure string, charges string").coalesce(1)
    for codec in ("deflate", "gzip", "bzip2", "snappy", "lz4"):
        path = str(tmp_path / codec)
        df.write.option("header", True).option("compression", codec).csv(path)
        out = build_trusted(spark, [path], CONTRACT, RUN, scratch=str(tmp_path / f"s_{codec}"))
        assert (out.trusted.count(), out.quarantine.count()) == (2, 0), codec


def test_wide_quoted_and_very_long_headers(spark, tmp_path):
    for n in (3000, 10000):
        names = [f'"extra, {i}"' for i in range(n)]
        path = _write(tmp_path / f"w{n}.csv", ",".join(["id", "tenure", "charges", *names]) + "\n" + "a,1,2.5" + ",x" * n + "\n")
        assert read_headers(spark, [path]).first().header[-1] == f"extra, {n - 1}"
    path = _write(tmp_path / "long.csv", "id,tenure,charges," + "x" * (2 << 20) + "\na,1,2.5,y\n")
    out = build_trusted(spark, [path], CONTRACT, RUN, scratch=str(tmp_path / "s_long"))
    assert (out.trusted.count(), out.quarantine.count()) == (1, 0)


def test_a_read_error_fails_the_run(spark, tmp_path):
    import gzip

    import pytest

    whole = gzip.compress(b"id,tenure,charges\n" + b"a,1,2\n" * 1000)
    (tmp_path / "broken.csv.gz").write_bytes(b"\x1f\x8b\x08\x00" + whole[4:20])
    with pytest.raises(Exception):
        build_trusted(spark, [str(tmp_path / "broken.csv.gz")], CONTRACT, RUN, scratch=str(tmp_path / "s")).trusted.count()


def test_the_caller_session_is_left_alone(spark, tmp_path):
    from pyspark.sql import SparkSession

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    read_headers(spark, [_write(tmp_path / "a.csv", "id\n1\n")]).collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert SparkSession.getActiveSession()._jsparkSession.equals(spark._jsparkSession)


def test_ragged_rows_pad_short_and_drop_extra_fields(spark, tmp_path):
    # a short row is padded with NULLs (its typed column then fails typing);
    # a long row keeps the contract's fields and loses the extra ones
    out = _run(spark, tmp_path, {"a.csv": "id,tenure,charges\na,1\nb,2,3.5,zzz\n"})
    assert [(r.id, r.tenure, r.charges) for r in out.trusted.collect()] == [("b", 2, 3.5)]
    rejects = [(r.record_key, r.rule, json.loads(r.original_record)) for r in out.quarantine.collect()]
    assert rejects == [("a", "not_numeric_charges", {"id": "a", "tenure": "1", "charges": None})]


def test_gzipped_batch_files(spark, tmp_path):
    import gzip

    a = tmp_path / "a.csv.gz"
    with gzip.open(a, "wt", encoding="utf-8") as f:
        f.write("charges, TENURE ,id\n2.5,1,a\n3.5,x,b\n")
    b = tmp_path / "b.csv.gz"
    with gzip.open(b, "wt", encoding="utf-8") as f:
        f.write("id,tenure\nz,1\n")
    from trustfold.sources.batches import read_headers

    heads = {r.source_file.rsplit("/", 1)[1]: list(r.header) for r in read_headers(spark, [str(a), str(b)]).collect()}
    assert heads == {"a.csv.gz": ["charges", " TENURE ", "id"], "b.csv.gz": ["id", "tenure"]}
    out = build_trusted(spark, [str(a), str(b)], CONTRACT, RUN, scratch=str(tmp_path / "s"))
    assert [(r.id, r.tenure, r.charges) for r in out.trusted.collect()] == [("a", 1, 2.5)]
    rules = sorted((r.rule, r.record_key) for r in out.quarantine.collect())
    assert rules == [("missing_column", None), ("not_numeric_tenure", "b")]


def test_many_layouts_and_many_files_in_one_scan(spark, tmp_path):
    """1,500 files in three layouts, a rejected one and empty ones: one reader, no file name on the driver."""
    layouts = [["id", "tenure", "charges"], ["charges", "x", "ID", " tenure "], ["tenure", "id", "y", "z", "Charges"], ["id", "tenure"]]
    for i in range(1500):
        header = layouts[i % 4]
        value = {"id": f"k{i}", "tenure": str(i), "charges": f"{i}.5"}
        row = ",".join(value.get(h.strip().lower(), "?") for h in header)
        (tmp_path / f"f{i}.csv").write_text("" if i % 500 == 7 else ",".join(header) + "\n" + row + "\n")
    routing = route_files(spark, [str(tmp_path)], CONTRACT)
    assert len(routing.layouts) == 3 and routing.routed.count() == 1500
    raw = read_accepted(spark, [str(tmp_path)], routing, CONTRACT)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [_c") == 1
    good = [i for i in range(1500) if i % 4 != 3 and i % 500 != 7]
    assert sorted((r.id, r.tenure, r.charges) for r in raw.collect()) == sorted((f"k{i}", str(i), f"{i}.5") for i in good)


def test_a_data_row_equal_to_the_header_is_kept(spark, tmp_path):
    out = _run(spark, tmp_path, {"a.csv": "id,tenure,charges\na,1,1\nid,tenure,charges\n"})
    assert [r.id for r in out.trusted.collect()] == ["a"]
    assert sorted(r.rule for r in out.quarantine.collect()) == ["not_numeric_charges", "not_numeric_tenure"]


def test_a_file_that_comes_after_the_headers_fails_the_run(spark, tmp_path):
    import pytest

    (tmp_path / "in").mkdir()
    _write(tmp_path / "in" / "a.csv", "id,tenure,charges\na,1,1\n")
    routing = route_files(spark, [str(tmp_path / "in")], CONTRACT)
    _write(tmp_path / "in" / "b.csv", "tenure,id,charges\n1,b,1\n")
    with pytest.raises(Exception, match="came after the headers"):
        read_accepted(spark, [str(tmp_path / "in")], routing, CONTRACT).collect()


def test_overlapping_paths_are_refused_and_equal_ones_read_once(spark, tmp_path):
    import pytest

    a = _write(tmp_path / "a.csv", "id,tenure,charges\na,1,1\n")
    assert build_trusted(spark, [a, a], CONTRACT, RUN, scratch=str(tmp_path / "s")).trusted.count() == 1
    with pytest.raises(ValueError, match="overlap"):
        read_headers(spark, [a, str(tmp_path)])


def test_no_paths(spark, tmp_path):
    assert read_headers(spark, []).count() == 0


def test_a_task_reads_the_first_line_of_one_file(spark, tmp_path):
    """A Python worker that stops early lives until its task ends: many files in one task would be as many workers."""
    from trustfold.sources.batches import first_lines

    n = 5 * spark.sparkContext.defaultParallelism
    for i in range(n):
        (tmp_path / f"{i}.csv").write_text(f"a,b{i}\n1,2\n3,4\n")
    sc = spark.sparkContext
    sc.setJobGroup("first-lines", "first lines")
    try:
        got = first_lines(spark, [str(tmp_path)])
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r["line"] for r in got.collect()) == sorted(f"a,b{i}" for i in range(n))
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("first-lines") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) == n


def test_headers_are_read_without_python_workers(spark, tmp_path):
    """The plans of the header step hold no Python node and no rows that were pickled by Python."""
    for i in range(6):
        (tmp_path / f"{i}.csv").write_text(f"id,tenure,charges\nk{i},1,2\n" if i % 2 else f"charges,id,tenure\n2,k{i},1\n")
    from trustfold.sources.batches import first_lines

    plans = [first_lines(spark, [str(tmp_path)]), route_files(spark, [str(tmp_path)], CONTRACT).routed]
    assert all("Python" not in p._jdf.queryExecution().toString() and "MapInArrow" not in p._jdf.queryExecution().toString()
               and "ExistingRDD" not in p._jdf.queryExecution().toString() for p in plans)


def test_the_first_line_of_a_file_of_several_splits(spark, tmp_path, monkeypatch):
    """Large files are read by several tasks; only the split that begins a file has its first line."""
    from trustfold.sources import batches

    monkeypatch.setattr(batches, "_SPLIT", 1 << 10)
    for name, long in (("a", 20), ("b", 3000)):
        (tmp_path / f"{name}.csv").write_text(f"id,{name * long}\n" + "".join(f"{i},x\n" for i in range(2000)))
    got = {r["line"] for r in batches.first_lines(spark, [str(tmp_path)]).collect()}
    assert got == {"id," + "a" * 20, "id," + "b" * 3000} and batches.first_lines(spark, [str(tmp_path)]).count() == 2
