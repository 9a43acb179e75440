"""Candidates for mentions: BM25, vectors, their fusion, and lexical lookup.

Queries are few and corpora large: statistics of the corpus are aggregations,
a query's words meet the postings in an equi-join, and a top-k is a
``row_number`` that Spark cuts down before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as X


def alias_corpus(kb: DataFrame) -> DataFrame:
    """(vocabulary, candidate_id, place, alias, norm): normalised aliases; a record without any counts by its name."""
    names = F.when(F.size("aliases") > 0, F.col("aliases")).otherwise(F.array_compact(F.array("canonical_name")))
    rows = kb.select("vocabulary", "candidate_id", F.posexplode(names).alias("place", "alias"))
    return rows.withColumn("norm", X.alias_key(F.col("alias"))).where("norm <> ''")


def top_k(scored: DataFrame, by: list[str], k: int, tie: str, score: str = "score") -> DataFrame:
    """The k best rows of each group with their ``rank``; ties go to the smaller ``tie``."""
    order = F.row_number().over(W.partitionBy(*by).orderBy(F.round(score, 6).desc(), F.col(tie)))
    return scored.withColumn("rank", order).where(F.col("rank") <= k)


def terms(rows: DataFrame, key: str, norm: str, least: int = 2) -> DataFrame:
    """(key, term, tf) of normalised texts; terms have at least ``least`` characters."""
    words = rows.select(key, F.explode(F.split(norm, " ")).alias("term")).where(F.length("term") >= least)
    return words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def bm25(corpus: DataFrame, queries: DataFrame, k: int, key: str = "doc", k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(query, key, score, rank) of the best texts of ``corpus`` (key, norm) for ``queries`` (query, norm).

    Only texts that share a term with the query count.
    """
    asked = terms(queries, "query", "norm").select("query", "term").distinct()
    # a text's length needs no rows of terms, and only terms that are asked for are gathered
    sizes = corpus.groupBy(key).agg(F.sum(F.coalesce(F.regexp_count("norm", F.lit("[^ ]{2,}")), F.lit(0))).alias("dl"))
    whole = sizes.agg(F.count(F.lit(1)).alias("n_docs"))
    mean = sizes.agg(F.sum("dl").alias("all_terms"))
    hit = corpus.select(key, F.explode(F.split("norm", " ")).alias("term")).where(F.length("term") >= 2).join(asked.select("term").distinct(), "term", "left_semi").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    df = hit.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    scored = hit.join(df, "term").join(sizes, key).join(asked, "term").crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(mean))  # one row each
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    long = 1 - b + b * F.col("dl") / (F.col("all_terms") / F.col("n_docs"))
    one = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * long)
    return top_k(scored.groupBy("query", key).agg(F.sum(one).alias("score")), ["query"], k, key)


#: Queries that go to all executors at once, and corpus vectors that are multiplied with them at once.
QUERY_BLOCK, ROW_BLOCK = 4_096, 512


def _best_of_batches(asked: pa.Table, key: str, k: int):
    """Candidates of each batch for the k best of each query: all scores (to six places) that the k-th best doesn't beat."""
    names = asked.column("query").to_numpy()
    matrix = np.stack(asked.column("embedding").to_numpy()).astype(np.float64).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), ROW_BLOCK):
                part = batch.slice(lo, ROW_BLOCK)
                ids = part.column(0).to_numpy()
                score = np.stack(part.column(1).to_numpy(zero_copy_only=False)).astype(np.float64) @ matrix
                rounded = np.round(score, 6)
                least = np.partition(rounded, -k, axis=0)[-k] if len(ids) > k else np.full(len(names), -np.inf)
                row, query = np.nonzero(rounded >= least)
                yield pa.RecordBatch.from_arrays([pa.array(names[query]), pa.array(ids[row]), pa.array(score[row, query])], names=["query", key, "score"])

    return run


def vectors(corpus: DataFrame, queries: DataFrame, k: int, key: str = "vec_id") -> DataFrame:
    """(query, key, score, rank) of the largest inner products of vectors (key, embedding) with queries (query, embedding).

    Each query is compared with each vector, as a flat index does: blocks of at
    most about ``QUERY_BLOCK`` queries go to all executors one after the other, the
    vectors stay where they are, and a batch gives back its best k for each query.
    """
    rows = corpus.where(F.col("embedding").isNotNull()).select(F.col(key).cast("long").alias(key), "embedding")
    asked = queries.where(F.col("embedding").isNotNull()).select(F.col("query").cast("long").alias("query"), "embedding")
    blocks = -(-asked.count() // QUERY_BLOCK)
    out = None
    for block in range(blocks):
        own = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        sent = own.toArrow()
        if len(sent):
            best = rows.mapInArrow(_best_of_batches(sent, key, k), f"query long, {key} long, score double")
            out = best if out is None else out.unionByName(best)
    if out is None:
        out = rows.select(F.lit(None).cast("long").alias("query"), key, F.lit(0.0).alias("score")).limit(0)
    return top_k(out, ["query"], k, key)


def rrf(lexical: DataFrame, semantic: DataFrame, k: int, key: str = "candidate_id", k_rrf: int = 60, w_lexical: float = 0.6, w_semantic: float = 0.4) -> DataFrame:
    """Reciprocal rank fusion of two rankings (query, key, rank) into (query, key, score, rank).

    A candidate with several hits counts by its best rank.
    """

    def best(ranked: DataFrame, name: str) -> DataFrame:
        return ranked.groupBy("query", key).agg(F.min("rank").alias(name))

    both = best(lexical, "a_").join(best(semantic, "b_"), ["query", key], "full_outer")
    score = F.coalesce(w_lexical / (F.col("a_") + k_rrf), F.lit(0.0)) + F.coalesce(w_semantic / (F.col("b_") + k_rrf), F.lit(0.0))
    return top_k(both.select("query", key, F.round(score, 6).alias("score")), ["query"], k, key)


def lexical_pool(corpus: DataFrame, queries: DataFrame, most: int = 1000) -> DataFrame:
    """(query, q_norm, candidate_id): candidates that share a word of three characters or more with the query.

    Without any, those with an alias that begins with the query's first four
    characters.  Of more than ``most``, those that share most words.
    """
    words = corpus.select("candidate_id", F.explode(F.array_distinct(F.split("norm", " "))).alias("term")).distinct()
    asked = queries.select("query", F.col("norm").alias("q_norm")).where("norm <> ''")
    q_words = asked.select("query", "q_norm", F.explode(F.array_distinct(F.split("q_norm", " "))).alias("term"))
    shared = q_words.join(words, "term").groupBy("query", "q_norm", "candidate_id").agg(F.count(F.lit(1)).alias("shared"), F.max(F.length("term")).alias("longest")).where("longest >= 3").drop("longest")
    lonely = asked.join(shared.select("query").distinct(), "query", "left_anti")
    start = lonely.withColumn("head", F.substring("q_norm", 1, 4))
    heads = corpus.select("candidate_id", "norm").distinct()
    # aliases of four characters or more meet the query's head by equality; for shorter heads a prefix is enough
    by_head = heads.withColumn("head", F.explode(F.array_distinct(F.array(*(F.substring("norm", 1, n) for n in range(1, 5))))))
    begun = start.join(by_head.select("head", "candidate_id").distinct(), "head").select("query", "q_norm", "candidate_id", F.lit(0).cast("long").alias("shared"))
    order = F.row_number().over(W.partitionBy("query").orderBy(F.col("shared").desc(), "candidate_id"))
    return shared.unionByName(begun).withColumn("place", order).where(F.col("place") <= most).select("query", "q_norm", "candidate_id")


def lexical(corpus: DataFrame, queries: DataFrame, k: int = 20, most: int = 1000, aliases: int = 6) -> DataFrame:
    """(query, candidate_id, score, method, rank): exact aliases score 1, others by sequence, word and n-gram similarity."""
    exact = queries.select("query", F.col("norm").alias("q_norm")).join(corpus.select("candidate_id", F.col("norm").alias("q_norm")).distinct(), "q_norm").select("query", "candidate_id", F.lit(1.0).alias("score"), F.lit("exact").alias("method"))
    pool = lexical_pool(corpus, queries, most).join(exact.select("query", "candidate_id"), ["query", "candidate_id"], "left_anti")
    first = corpus.withColumn("nth", F.row_number().over(W.partitionBy("candidate_id").orderBy("place"))).where(F.col("nth") <= aliases)
    near = pool.join(first.select("candidate_id", "norm"), "candidate_id").withColumn("one", S.lexical_score(F.col("q_norm"), F.col("norm")))
    near = near.groupBy("query", "candidate_id").agg(F.max("one").alias("score")).select("query", "candidate_id", "score", F.lit("lexical").alias("method"))
    ranked = exact.unionByName(near)
    order = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), "candidate_id"))
    return ranked.withColumn("rank", order).where(F.col("rank") <= k).withColumn("score", F.round("score", 6))


def vocabulary_of(kind: Column, vocabularies: dict[str, str]) -> Column:
    """Vocabulary in which a type is looked up, or null."""
    return F.try_element_at(X.mapping(vocabularies), kind)


def link(entities: DataFrame, ranked: DataFrame, known: DataFrame, vocabularies: dict[str, str], output_k: int | None = None, least: float | None = None, keep_detected: bool = False) -> DataFrame:
    """Entities with their ``candidates``, best first.

    ``ranked`` has (vocabulary, norm, candidate_id, score, rank) of the mentions'
    normalised texts.  With ``keep_detected``, the candidate that the dictionary
    found comes alone if ``known`` (vocabulary, candidate_id) has it.
    """
    rows = entities.withColumn("vocabulary", vocabulary_of(F.col("type"), vocabularies)).withColumn("norm", X.alias_key(F.col("text")))
    best = ranked if least is None else ranked.where(F.col("score") >= least)
    best = best if output_k is None else best.where(F.col("rank") <= output_k)
    lists = best.groupBy("vocabulary", "norm").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "candidate_id"))), lambda x: x["candidate_id"]).alias("found"))
    out = rows.join(lists, ["vocabulary", "norm"], "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    if keep_detected:
        ids = known.select("vocabulary", F.col("candidate_id"), F.lit(True).alias("is_known")).distinct()
        out = out.join(ids, ["vocabulary", "candidate_id"], "left")
        found = F.when(F.col("is_known"), F.array("candidate_id")).otherwise(found)
    return out.withColumn("candidates", found).select(*entities.columns, "vocabulary", "candidates")
