"""Pipeline over documents: toxicity, exact dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next stage's ``docs``.  All stages but the last
return the columns of ``documents`` as they were.

Defined results: a stage gets what its operator defines for nulls, empty and
very long texts, repeated rows and empty tables; columns besides doc_id, text,
lang and source may have any names and are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswerk.llm.bpe import bpe_digests
from glosswerk.llm.common import table, written
from glosswerk.llm.exact_dedup import drop_copies
from glosswerk.llm.minhash import drop_near_duplicates
from glosswerk.llm.mixing import drop_unmixed
from glosswerk.llm.queries import MIX_WEIGHTS, source_domain, vocabulary_path
from glosswerk.llm.toxicity import drop_toxic

#: Share of the tokens that the mix takes, in per cent.
MIX_PERCENT, MIX_SEED = 80, 23


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, learned from ``labels``, doesn't reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate groups (five words, similarity 0.8 or more), the one with the smallest doc_id."""
    return drop_near_duplicates(docs, k=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix of sources, each at most once."""
    return drop_unmixed(docs, source_domain(), MIX_PERCENT, MIX_WEIGHTS, MIX_SEED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the text's tokens: their number, digest, and the decoded text's digest."""
    coded = bpe_digests(docs, vocabulary_path(), keep=("lang", "source"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: SQL can't express the network, the shingle sets at this size, or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
