"""The training-data pipeline: toxicity, near duplicates, decontamination, mixing, shards.

Each stage is one operator of ``trustfold.llm`` over all that the stage
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trustfold.llm.decontaminate import decontaminated
from trustfold.llm.jaccard_join import one_of_each
from trustfold.llm.mixing import mixed
from trustfold.llm.sharding import Tree, sharded
from trustfold.llm.tables import stored
from trustfold.llm.toxicity import drop_toxic


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, similarity 0.8."""
    return one_of_each(docs, words=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages of ten words or more are cut out."""
    return decontaminated(docs, _table(spark, sf_dir, "benchmark"), window=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1: every document as often as the mix takes it."""
    return mixed(docs, weights=(5, 2, 1), share=1.0, max_repeats=3)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row, in 2 regions of 4 racks of 5 shards."""
    return sharded(docs, tree=Tree.even(2, 4, 5))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: Trees, components and seeded selection are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
