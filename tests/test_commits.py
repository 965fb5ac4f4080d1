"""All-or-nothing publishing: failures, readers, two publishers, what is left behind."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from trustfold.operators.quarantine import Run, from_file_errors, from_rows
from trustfold.operators.report import rejected_values
from trustfold.sinks.commits import ConcurrentPublish, Store, Version
from trustfold.sinks.tables import clear_run, publish_ledger, read_ledger, read_table, replace_table


def rejects(spark, run_id, n, stage="trusted"):
    df = spark.createDataFrame([(str(i), "x", "f") for i in range(n)], "id string, v string, _source_file string")
    return from_rows(df, "r", Run(run_id, "2026-08-03T00:00:00Z", stage=stage), key="id")


def per_run(spark, path):
    return {r.run_id: r["count"] for r in read_ledger(spark, path).groupBy("run_id").count().collect()}


class Killed(BaseException):
    """Ends a publish the way a dead driver does: nothing is cleaned up behind it."""


@pytest.fixture
def killed_before_switch(monkeypatch):
    def die(self, version):
        raise Killed

    def switch_on():
        monkeypatch.undo()

    monkeypatch.setattr(Store, "_switch", die)
    monkeypatch.setattr(Store, "abandon", lambda self, attempt: None)
    return switch_on


def attempts(path):
    return [n for n in os.listdir(path) if n.startswith("attempt=")]


def test_a_failed_rerun_keeps_the_table_whole(spark, tmp_path):
    path = str(tmp_path / "t[1]")  # names are taken literally
    replace_table(spark.range(10), path, files=3)
    bad = spark.range(1000).select(F.when(F.col("id") == 900, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("id")).repartition(7)
    with pytest.raises(Exception, match="boom"):
        replace_table(bad, path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(10))
    assert len(attempts(path)) == 1


def test_a_reader_during_a_rerun_keeps_the_former_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(10), path)
    before = read_table(spark, path)
    replace_table(spark.range(20), path)
    assert before.count() == 10 and read_table(spark, path).count() == 20
    replace_table(spark.range(30), path)  # the first version goes with the commit after the next
    assert len(attempts(path)) == 2 and read_table(spark, path).count() == 30


def test_partitioned_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(6).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    got = read_table(spark, path)
    assert sorted(map(tuple, got.collect())) == [(i, i % 2) for i in range(6)] and got.columns == ["id", "p"]
    replace_table(spark.range(0), path)
    assert read_table(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_killed_between_write_and_switch(spark, tmp_path, killed_before_switch):
    path, ledger = str(tmp_path / "t"), str(tmp_path / "l")
    with pytest.raises(Killed):
        replace_table(spark.range(5), path)
    with pytest.raises(Killed):
        publish_ledger(rejects(spark, "A", 3), ledger, run_id="A")
    assert read_ledger(spark, ledger).count() == 0
    killed_before_switch()
    replace_table(spark.range(6), path)
    publish_ledger(rejects(spark, "A", 4), ledger, run_id="A")
    assert read_table(spark, path).count() == 6 and per_run(spark, ledger) == {"A": 4}
    assert len(attempts(path)) == 2 and len(attempts(ledger)) == 2
    assert Store(spark, path).sweep() == []  # too young to be given up
    assert len(Store(spark, path).sweep(older_than_s=0)) == 1 and read_table(spark, path).count() == 6


def test_killed_publish_leaves_the_old_slice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "l")
    publish_ledger(rejects(spark, "A", 3), path, run_id="A")
    publish_ledger(rejects(spark, "B", 2), path, run_id="B")
    with monkeypatch.context() as m:
        m.setattr(Store, "_switch", lambda self, version: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            publish_ledger(rejects(spark, "A", 9), path, run_id="A")
    assert per_run(spark, path) == {"A": 3, "B": 2}


def test_two_runs_at_once_keep_both(spark, tmp_path):
    path = str(tmp_path / "l")
    names = [f"run{i}" for i in range(6)]
    failed = []

    def publish(i, name):
        try:
            publish_ledger(rejects(spark, name, i + 1), path, run_id=name)
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=publish, args=x) for x in enumerate(names)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and per_run(spark, path) == {n: i + 1 for i, n in enumerate(names)}


def test_the_same_slice_twice_at_once_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "l")
    publish_ledger(rejects(spark, "A", 1), path, run_id="A")
    real, once = Store.commit, []

    def overtaken(self, base, written, *replaces):
        if not once:
            once.append(1)
            publish_ledger(rejects(spark, "A", 5), path, run_id="A")
        return real(self, base, written, *replaces)

    monkeypatch.setattr(Store, "commit", overtaken)
    with pytest.raises(ConcurrentPublish):
        publish_ledger(rejects(spark, "A", 7), path, run_id="A")
    assert per_run(spark, path) == {"A": 5}
    once.clear()
    table = str(tmp_path / "t")

    def other(self, base, written, *replaces):
        if not once:
            once.append(1)
            replace_table(spark.range(3), table)
        return real(self, base, written, *replaces)

    monkeypatch.setattr(Store, "commit", other)
    with pytest.raises(ConcurrentPublish):
        replace_table(spark.range(4), table)
    assert read_table(spark, table).count() == 3


def test_other_stages_of_a_run_go_in_the_same_commit(spark, tmp_path):
    path = str(tmp_path / "l")
    publish_ledger(rejects(spark, "A", 2).unionByName(rejects(spark, "A", 3, "typing")), path, run_id="A")
    version = Store(spark, path).current().number
    publish_ledger(rejects(spark, "A", 1), path, run_id="A")
    assert Store(spark, path).current().number == version + 1 and per_run(spark, path) == {"A": 1}
    publish_ledger(rejects(spark, "A", 0), path, run_id="A")
    assert per_run(spark, path) == {} and clear_run(spark, path, "A") == 0
    publish_ledger(rejects(spark, "A", 0), path, run_id="A")  # nothing to say: no new version
    assert Store(spark, path).current().number == version + 2


def test_only_the_runs_folders_are_opened(spark, tmp_path):
    path = str(tmp_path / "l")
    for name in ("A", "B/1"):
        publish_ledger(rejects(spark, name, 2), path, run_id=name)
    one = read_ledger(spark, path, run_id="B/1")
    assert one.count() == 2 and all("run_id=B%2F1" in f for f in map(lambda x: x.replace("%252F", "%2F"), one.inputFiles()))


@pytest.mark.parametrize("how", ["_link", "_rename"])
def test_a_number_is_given_once(spark, tmp_path, monkeypatch, how):
    monkeypatch.setattr(Store, "_link", getattr(Store, how))
    store = Store(spark, str(tmp_path / "s"))
    assert store._switch(Version(1, {"": "a"})) and not store._switch(Version(1, {"": "b"}))
    assert store.current().slices == {"": "a"} and store.children("_manifests") == ["000000000001"]


def test_many_commits_keep_few_manifests(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for i in range(30):
        store.commit(store.current(), {"": f"attempt={i}"})
    assert len(store.children("_manifests")) == 20 and store.current().slices == {"": "attempt=29"}


def test_values_of_rejected_records(spark, tmp_path):
    path = str(tmp_path / "l")
    rows = [("1", "abc", "a.b", "typed"), ("2", "99", "a.b", "typed"), ("3", "abc", None, "typed"), ("4", "x", "q", "other")]
    df = spark.createDataFrame(rows, ["id", "it's", "dotted", "__rule"]).withColumn("_source_file", F.lit("f"))
    publish_ledger(from_rows(df, F.col("__rule"), Run("A", "2026-08-03T00:00:00Z"), key="id"), path)
    got = sorted(map(tuple, rejected_values(read_ledger(spark, path), {"typed": ("it's", "dotted", "gone")}).collect()), key=str)
    assert got == sorted([("typed", "it's", "abc", 2, 0), ("typed", "it's", "99", 1, 1), ("typed", "dotted", "a.b", 2, 0), ("typed", "dotted", None, 1, 0),
                          ("typed", "gone", None, 3, 0)], key=str)


def test_names_of_rejected_headers(spark, tmp_path):
    path = str(tmp_path / "l")
    heads = spark.createDataFrame([("f1", "missing_column", "x", ["id", "7", " A"]), ("f2", "missing_column", "x", ["id"])],
                                  "source_file string, rule string, column string, header array<string>")
    publish_ledger(from_file_errors(heads, Run("A", "2026-08-03T00:00:00Z")), path)
    got = sorted(map(tuple, rejected_values(read_ledger(spark, path), {}, {"missing_column": "header"}).collect()))
    assert got == [("missing_column", "header", " A", 1, 0), ("missing_column", "header", "7", 1, 1), ("missing_column", "header", "id", 2, 0)]
