"""The operators bound to the driver's tables: query name -> builder, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trustfold.llm import oracles
from trustfold.llm.tables import documents
from trustfold.session import scratch_path

Builder = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.toxicity import toxicity_scores

    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity_scores(documents(spark, sf_dir, "doc_id", "text"), labels)


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.winnowing import with_edits

    return with_edits(documents(spark, sf_dir, "doc_id", "text"), k=24, window=64)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.licenses import scan

    return scan(documents(spark, sf_dir, "doc_id", "text")).drop("spans")


URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.url_filter import Rule, judge, rules_table

    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return judge(pages, rules_table(spark, [Rule.of(*r) for r in URL_RULES]))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from trustfold.llm.token_counts import token_counts

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    return token_counts(documents(spark, sf_dir, "doc_id", "text"), definition, limit=512)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.sharding import Tree, sharded

    return sharded(documents(spark, sf_dir, "doc_id", "text"), tree=Tree.even(2, 4, 5))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.jaccard_join import jaccard_components

    return jaccard_components(documents(spark, sf_dir, "doc_id", "text"), words=4, num=85, den=100)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.mixing import taken_words

    return taken_words(documents(spark, sf_dir, "doc_id", "text", "source"), weights=(5, 2, 1), share=1.0, max_repeats=3)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.warc import round_trip

    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return round_trip(pages, scratch_path(spark, "llm", "warc"), min_bytes=0)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.decontaminate import contamination_digest

    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return contamination_digest(documents(spark, sf_dir, "doc_id", "text"), items, window=10)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from trustfold.llm.sentencepieces import digests, pieces_and_texts

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return digests(pieces_and_texts(documents(spark, sf_dir, "doc_id", "text"), model))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.filter_audit import filter_audit

    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return filter_audit(documents(spark, sf_dir, "doc_id", "text", "source"), labels)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustfold.llm.merkle import audited

    return audited(documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, tuple[Builder, str | None]] = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_winnowing": (op2_winnowing, None),
    "op3_license_scan": (op3_license_scan, None),
    "op4_url_filter": (op4_url_filter, None),
    "op5_token_counts": (op5_token_counts, None),
    "op6_sharding": (op6_sharding, None),
    "op7_jaccard_join": (op7_jaccard_join, oracles.JACCARD_JOIN),
    "op8_mixing": (op8_mixing, None),
    "op9_warc": (op9_warc, oracles.WARC),
    "op10_decontaminate": (op10_decontaminate, oracles.DECONTAMINATE),
    "op11_sentencepiece": (op11_sentencepiece, None),
    "op12_filter_audit": (op12_filter_audit, oracles.FILTER_AUDIT),
    "op13_merkle": (op13_merkle, oracles.MERKLE),
    "pipeline": (pipeline, None),
}
