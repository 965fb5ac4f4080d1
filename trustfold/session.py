"""Session-level helpers: the shared scratch folder and lineage cuts.

Everything that has to land on storage in the middle of a job (staged
batches, materialised intermediate tables) goes below the folder the
cluster names in ``spark.checkpoint.dir``.  That folder is shared by all
executors, so a lost executor never takes a materialised table with it.
Only when the setting is absent *and* Spark runs in local mode do we pick
a folder ourselves (tests, notebooks on a laptop).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """Return the shared scratch root (``spark.checkpoint.dir``, or the
    folder given to ``SparkContext.setCheckpointDir``).

    Sets a fresh local folder only when both are missing and the master is
    local; on a cluster a missing setting is an error, because a
    machine-local folder would not be visible to the other executors.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        # a folder set through SparkContext.setCheckpointDir counts as well
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set; set it to a folder every executor can reach"
            )
        root = tempfile.mkdtemp(prefix="trustfold-scratch-")
        # (the conf key itself cannot be changed on a running session)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder name below the scratch root (not created)."""
    # join the parts without touching the root: it may be a URI (``gs://b/ck``)
    segments = [p.strip("/") for p in ("trustfold", *parts, uuid.uuid4().hex) if p and p.strip("/")]
    return "/".join([scratch_root(spark), *segments])


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more (through Hadoop's
    file system, so on any store; a missing folder is fine)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    This is the lineage cut used between stages that fan out (one tagged
    frame feeding both the trusted table and the quarantine): the upstream
    scan runs exactly once, every consumer sees the same rows, and a lost
    executor re-reads files instead of recomputing the whole lineage.
    The re-read also gives AQE real file sizes to plan joins with.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, "materialized", name)
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


#: Files one task holds open at once while it writes a partitioned CSV (each a small buffer); a task with more folders sorts the rest.
OPEN_FILES = 64


def unsorted_writer(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings whose partitioned writes keep a file open per folder.

    By default a task sorts all its rows by folder first and holds them in
    memory until it spills.  The caller's own settings stay as they are.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    return own
