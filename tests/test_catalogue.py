"""Queries against their SQL over the driver's smallest tables."""

import os

import pytest
from comparing import SF_DIR, both

import __spark_entry__ as entry
from glosswerk.plans import catalogue

COMPARED = [
    "doc_stats", "natural_order", "duplicate_ids", "alias_normalize", "tokens_with_offsets", "sentences", "sections", "token_windows", "phrase_dictionary", "dictionary_hits",
    "medication_attributes", "kb_group", "kb_concepts", "kb_icd", "kb_edges", "kb_metadata", "bm25_topk", "vector_topk", "similarities", "lexical_pool", "validate_submission",
    "hit_at_k", "token_metrics", "split", "fingerprint", "submission", "exact_metrics",
    "relation_examples", "window_features", "choice_schema", "relation_pairs", "bio_labels",
]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
@pytest.mark.parametrize("name", COMPARED)
def test_query_is_its_sql(spark, name):
    ours, theirs = both(spark, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])
    assert ours == theirs
    spark.catalog.clearCache()


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
def test_vectors_in_blocks(spark, monkeypatch):
    from glosswerk.operators import retrieval as R

    monkeypatch.setattr(R, "QUERY_BLOCK", 3)
    monkeypatch.setattr(R, "ROW_BLOCK", 40)
    ours, theirs = both(spark, catalogue.QUERIES["vector_topk"], catalogue.ORACLE_SQL["vector_topk"])
    assert ours == theirs
    none = spark.createDataFrame([], "query long, embedding array<float>")
    assert R.vectors(spark.read.parquet(f"{SF_DIR}/embeddings.parquet"), none, 3).collect() == []
