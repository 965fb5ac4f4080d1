"""The shared scratch folder: taken from the session, never invented on a cluster."""

import pytest

from trustfold.session import scratch_path, scratch_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self.checkpoint = checkpoint

    def getCheckpointDir(self):  # noqa: N802 - Spark's name
        return self.checkpoint

    def setCheckpointDir(self, path):  # noqa: N802 - Spark's name
        self.checkpoint = path


class _Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, checkpoint)


def test_conf_setting_wins():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ck/"}, "hdfs://nn/other/uuid")
    assert scratch_root(s) == "hdfs://nn/shared/ck"
    assert scratch_path(s, "tagged", "run-1").startswith("hdfs://nn/shared/ck/trustfold/tagged/run-1/")


def test_context_checkpoint_folder_is_used():
    s = _Session("yarn", checkpoint="gs://bucket/ck/uuid")
    assert scratch_root(s) == "gs://bucket/ck/uuid"


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError):
        scratch_root(_Session("yarn"))


def test_local_mode_without_setting_picks_one_folder():
    s = _Session("local[2]")
    first = scratch_root(s)
    assert s.sparkContext.getCheckpointDir() == first
    assert scratch_root(s) == first


def test_real_session_uses_its_setting(spark):
    root = scratch_root(spark)
    want = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root == want.rstrip("/")


def test_scratch_path_keeps_uri_roots_and_drops_empty_parts():
    s = _Session("yarn", {"spark.checkpoint.dir": "s3a://bucket/ck"})
    p = scratch_path(s, "/a/", "", "b")
    assert p.startswith("s3a://bucket/ck/trustfold/a/b/") and "//" not in p[len("s3a://"):]


def test_a_partitioned_write_without_a_sort_keeps_the_callers_settings(spark, tmp_path):
    from pyspark.sql import functions as F
    from trustfold.bindings.q_profile import lineitem_text
    from trustfold.session import OPEN_FILES, unsorted_writer

    key = "spark.sql.maxConcurrentOutputFileWriters"
    zone, before = spark.conf.get("spark.sql.session.timeZone"), spark.conf.get(key)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        own = unsorted_writer(spark)
        assert own.conf.get(key) == str(OPEN_FILES) and spark.conf.get(key) == before
        assert own.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        df = own.range(3000).select("id", (F.col("id") % (2 * OPEN_FILES)).alias("folder"))  # more folders than files held open
        df.write.partitionBy("folder").csv(str(tmp_path / "t"))
        back = spark.read.csv(str(tmp_path / "t"), schema="id long, folder long")
        assert {(r.id, r.folder) for r in back.collect()} == {(i, i % (2 * OPEN_FILES)) for i in range(3000)} and back.count() == 3000
        assert lineitem_text(own, "/root/testdata/sf0.001").sparkSession.conf.get(key) == str(OPEN_FILES)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
