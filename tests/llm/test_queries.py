"""The bound queries, their contract columns, and the pipeline's stages."""

import re

import pytest

import corpus_pipeline
from trustfold.llm.queries import QUERIES

COLUMNS = {
    "op1": "doc_id held_out score predicted", "op2": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3": "doc_id n_words n_base first_word last_word base_labels labels score", "op4": "page_id host path rule verdict",
    "op5": "doc_id n_bytes n_tokens over_limit", "op6": "doc_id size text_crc32 law shard slot grown_shard", "op7": "doc_id n_shingles component_id",
    "op8": "doc_id size source_size target taken", "op9": "page_id payload_bytes payload_digest record_type refers_to",
    "op10": "doc_id n_words n_hit n_items items_sha256 contaminated", "op11": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op13": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


def test_all_operators_and_the_pipeline_are_registered():
    assert [re.match(r"op\d+|pipeline", n)[0] for n in QUERIES] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("pipeline", "op12_filter_audit")])
def test_every_row_comes_back(spark, sf, name):
    table, key = ("pages", "page_id") if re.match("op4_|op9_", name) else ("documents", "doc_id")
    out = QUERIES[name][0](spark, sf)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(out.columns)
    want = sorted(r[0] for r in spark.read.parquet(f"{sf}/{table}.parquet").select(key).collect())
    assert sorted(r[key] for r in out.select(key).collect()) == want


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"  # enough labels to tell toxic from clean
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], sf).cache())
    first, safe, single, clean, mix, shards = seen
    for d in (safe, single, clean, mix):
        assert d.columns == docs.columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    assert single.count() == len(ids[2]) and shards.count() == mix.count()
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    gone = [marks[i] for i in ids[0] - ids[1] if i in marks]
    assert sum(gone) >= 0.9 * len(gone)
    assert corpus_pipeline.run(spark, sf).count() == shards.count()
