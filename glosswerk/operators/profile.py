"""Figures, checks, fingerprints and splits of document sets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X

_LINE_END = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}]"


def line_count(text: Column) -> Column:
    """Lines, the last one also without a line end."""
    ends = F.regexp_count(text, F.lit(_LINE_END))
    open_end = (F.length(text) > 0) & ~F.rlike(text, F.lit(rf"(?s)(?:{_LINE_END})\z"))
    return ends + F.when(open_end, 1).otherwise(0)


def describe(docs: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """One row: least, most and mean of characters, lines and entities of a document; null without documents."""
    rows = docs.select("document_id", F.length("raw_text").alias("characters"), line_count(F.col("raw_text")).alias("lines"))
    if entities is not None:
        rows = rows.join(entities.groupBy("document_id").agg(F.count(F.lit(1)).alias("entities")), "document_id", "left").na.fill(0, ["entities"])
    figures = [f(c).alias(f"{n}_{c}") for c in rows.columns[1:] for n, f in (("min", F.min), ("max", F.max), ("mean", lambda x: F.round(F.avg(x), 2)))]
    return rows.agg(F.count(F.lit(1)).alias("documents"), *figures)


def duplicate_ids(docs: DataFrame) -> DataFrame:
    return docs.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique_ids(docs: DataFrame) -> DataFrame:
    """The documents; an error if two have one id."""
    found = duplicate_ids(docs).orderBy("document_id").limit(10).collect()
    if found:
        raise ValueError(f"duplicate document ids: {[r['document_id'] for r in found]}")
    return docs


def in_natural_order(docs: DataFrame) -> DataFrame:
    return docs.orderBy(*X.natural_key(F.col("document_id")))


def validate(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: entities, distinct candidates, overlaps with the entity before, repeated annotations, offset errors."""
    rows = entities.join(docs.select("document_id", "raw_text"), "document_id", "left")
    order = W.partitionBy("document_id").orderBy("start", "end", "ord")
    before = F.lag("end").over(order)
    rows = rows.withColumn("overlap", F.coalesce(F.col("start") < before, F.lit(False))).withColumn("valid", X.offsets_valid(F.col("raw_text"), F.col("start"), F.col("end"), F.col("text")))
    same = rows.groupBy("document_id", "start", "end", "type", "candidates", "assertions").agg(F.count(F.lit(1)).alias("n"), F.count_if("overlap").alias("o"), F.count_if(~F.col("valid")).alias("bad"))
    figures = same.agg(F.sum("n").alias("entities"), F.sum("o").alias("overlaps"), F.sum(F.col("n") - 1).alias("duplicates"), F.sum("bad").alias("offset_errors")).na.fill(0)
    distinct = entities.select(F.explode("candidates").alias("c")).agg(F.count_distinct("c").alias("candidates"))
    return docs.agg(F.count(F.lit(1)).alias("documents")).crossJoin(F.broadcast(figures)).crossJoin(F.broadcast(distinct))  # one row each


def offset_errors(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities whose text isn't what the document has at their place, with 30 characters of context."""
    rows = entities.join(docs.select("document_id", "raw_text"), "document_id", "left")
    wrong = ~X.offsets_valid(F.col("raw_text"), F.col("start"), F.col("end"), F.col("text"))
    return rows.where(wrong).withColumn("context", X.context(F.col("raw_text"), F.col("start"), F.col("end"), 30)).drop("raw_text")


def value_counts(entities: DataFrame, column: str) -> DataFrame:
    """(value, n) of a column, or of the values in an array column; the most frequent first."""
    col = F.explode(column) if dict(entities.dtypes)[column].startswith("array") else F.col(column)
    return entities.select(col.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "value")


def fingerprints(docs: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """(document_id, digest) of id and text, and of all columns of the document's entities by start, end and type."""
    body = F.concat(F.col("document_id"), F.lit("\0"), F.col("raw_text"), F.lit("\0"))
    if entities is not None:
        line = F.to_json(F.struct(*sorted(c for c in entities.columns if c != "document_id")))
        place = F.struct("start", "end", "type", line.alias("line"))
        said = entities.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["line"]), "").alias("said_"))
        docs = docs.join(said, "document_id", "left")
        body = F.concat(body, F.coalesce("said_", F.lit("")))
    return docs.select("document_id", F.sha2(body.cast("binary"), 256).alias("digest"))


def fingerprint(docs: DataFrame, groups: int = 256, entities: DataFrame | None = None) -> DataFrame:
    """One row: the digest of a set of documents, with their entities if given, whatever their order and partitions.

    Documents are put into groups by their digest's first two digits; a group's
    digests in order make its digest, and the groups' digests in order the set's.
    With more documents, take more groups (a power of 16).
    """
    digits = round(math.log(groups, 16))
    if 16**digits != groups:
        raise ValueError("groups must be a power of 16")
    parts = fingerprints(docs, entities).groupBy(F.substring("digest", 1, digits).alias("g")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("digest")), "").cast("binary"), 256).alias("d"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("g", "d"))), lambda x: x["d"]), "")
    return parts.agg(F.sha2(whole.cast("binary"), 256).alias("fingerprint"))


def split(docs: DataFrame, percent: int = 20, seed: int = 42) -> DataFrame:
    """Documents with their ``part``, train or validation, by a seeded digest of the id: whole documents, the same in any order."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("document_id")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return docs.withColumn("part", F.when(bucket < percent, "validation").otherwise("train"))


def exact_split(ids: list[str], fraction: float = 0.2, seed: int = 42) -> tuple[list[str], list[str]]:
    """Train and validation ids of a small set, shuffled by Python's generator; at least one for validation, of two or more."""
    import random

    if len(ids) < 2:
        return list(ids), []
    shuffled = list(ids)
    random.Random(seed).shuffle(shuffled)
    n = max(1, round(len(shuffled) * fraction))
    return shuffled[n:], shuffled[:n]


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables have the same rows, as bags: for comparing two runs of a plan."""
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
