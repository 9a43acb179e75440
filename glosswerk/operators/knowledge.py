"""Knowledge bases: rows of a source grouped into records, filtered edges, figures and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def in_order(value: Column, order: Column, when: Column | None = None) -> Column:
    """Aggregate: distinct values (or values of arrays) in the order of their first row; empty ones are left out."""
    pair = F.struct(order.alias("o"), value.alias("v"))
    kept = value.isNotNull() if when is None else value.isNotNull() & when
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(kept, pair))), lambda x: x["v"]))


def first_filled(value: Column, order: Column) -> Column:
    """Aggregate: the first value that isn't empty, or the empty text."""
    return F.coalesce(F.min_by(value, F.when(value != "", order)), F.lit(""))


def icd_records(rows: DataFrame) -> DataFrame:
    """Records of sheet rows (ord, display_code, code_without_dot, name_en, name_vi).

    A code that disagrees with the sheet's own form without a dot is an error.
    """
    cells = rows.select("ord", *(X.cell_text(F.col(c)).alias(c) for c in ("display_code", "code_without_dot", "name_en", "name_vi")))
    cells = cells.withColumn("candidate_id", X.icd_code(F.col("display_code"))).where("candidate_id <> ''")
    plain = F.replace("candidate_id", F.lit("."))
    bad = (F.col("code_without_dot") != "") & (F.col("code_without_dot") != plain)
    cells = cells.withColumn("plain", F.when(bad, F.raise_error(F.concat(F.lit("code mismatch: "), F.col("display_code")))).otherwise(plain))
    filled = lambda *c: F.filter(F.array(*c), lambda x: x != "")
    order = F.col("ord")

    def distinct(value: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])))

    grouped = cells.groupBy("candidate_id").agg(
        F.min("plain").alias("code_without_dot"),
        first_filled(F.col("name_vi"), order).alias("name_vi"),
        first_filled(F.col("name_en"), order).alias("name_en"),
        distinct(filled("candidate_id", "plain", "name_en", "name_vi")).alias("aliases"),
        distinct(filled("name_en", "name_vi")).alias("detection_aliases"),
        in_order(F.col("display_code"), order).alias("display_codes"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), X.icd_markers(F.col("display_code")).alias("v")))), lambda x: x["v"])).alias("markers"),
    )
    return grouped.withColumn("vocabulary", F.lit("ICD10")).withColumn("canonical_name", F.when(F.col("name_vi") != "", F.col("name_vi")).otherwise(F.col("name_en")))


def concept_rows(rows: DataFrame, languages: list[str], sources: list[str], kinds: list[str], suppress: list[str]) -> DataFrame:
    """Rows of a concept file with wanted language, source, term type and suppression."""
    return rows.where(F.col("LAT").isin(*languages) & F.col("SAB").isin(*sources) & F.col("TTY").isin(*kinds) & F.col("SUPPRESS").isin(*suppress))


def concept_records(rows: DataFrame) -> DataFrame:
    """Records of concept rows (ord, RXCUI, STR, TTY, SAB)."""
    order, name = F.col("ord"), F.col("STR")
    grouped = rows.groupBy(F.col("RXCUI").alias("candidate_id")).agg(
        F.min_by("STR", "ord").alias("canonical_name"),
        in_order(name, order).alias("aliases"),
        in_order(F.col("TTY"), order).alias("tty"),
        in_order(F.col("SAB"), order).alias("sources"),
        in_order(name, order, F.col("TTY") == "BN").alias("brand_names"),
    )
    return grouped.withColumn("detection_aliases", F.col("aliases")).withColumn("vocabulary", F.lit("RXNORM"))


def relation_rows(rows: DataFrame, relations: list[str], sources: list[str]) -> DataFrame:
    """Edges (source_rxcui, relation, target_rxcui, sab) of wanted relations and sources; rows without an id aren't edges."""
    kept = rows.where(F.col("RELA").isin(*relations) & F.col("SAB").isin(*sources))
    filled = (F.coalesce("RXCUI1", F.lit("")) != "") & (F.coalesce("RXCUI2", F.lit("")) != "")
    return kept.where(filled).select(F.col("RXCUI1").alias("source_rxcui"), F.col("RELA").alias("relation"), F.col("RXCUI2").alias("target_rxcui"), F.col("SAB").alias("sab"))


def by_length(column: str = "candidate_id") -> list[Column]:
    """Order of ids that are numbers written as text: the shorter first."""
    return [F.length(column), F.col(column)]


def counts_of(rows: DataFrame, column: str) -> DataFrame:
    """(value, n) of a column of strings or lists of strings, for the figures of a dictionary: term types, markers."""
    listed = dict(rows.dtypes)[column].startswith("array")
    return rows.select(F.explode(column).alias("value") if listed else F.col(column).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy("value")


def record_figures(records: DataFrame) -> DataFrame:
    """One row: candidates, distinct normalised aliases, aliases, records without a name."""
    aliases = records.select(F.explode("aliases").alias("a")).select(X.alias_key(F.col("a")).alias("norm")).where("norm <> ''")
    counts = aliases.agg(F.count(F.lit(1)).alias("aliases"), F.count_distinct("norm").alias("distinct_aliases"))
    return records.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.coalesce("canonical_name", F.lit("")) == "").alias("unnamed")).crossJoin(F.broadcast(counts))  # one row


def verify_records(records: DataFrame, expected: int | None = None) -> dict[str, int]:
    """Counts of a dictionary; an error if an id is missing or repeated, or the count isn't ``expected``."""
    filled = F.coalesce("candidate_id", F.lit("")) != ""
    row = records.agg(F.count(F.lit(1)).alias("n"), F.count_if(~filled).alias("missing"), F.count_distinct(F.when(filled, F.col("candidate_id"))).alias("ids")).first()
    if row["missing"]:
        raise ValueError(f"{row['missing']} records without candidate_id")
    if expected is not None and row["n"] != expected:
        raise ValueError(f"expected {expected} records, found {row['n']}")
    if row["ids"] != row["n"]:
        raise ValueError(f"{row['n'] - row['ids']} records with a candidate_id that another has")
    return {"record_count": row["n"], "unique_ids": row["ids"]}


def enrich(kb: DataFrame, gold: DataFrame, first: str = "ICD10") -> DataFrame:
    """Records with the gold mentions (candidate_id, text, ord) of their id added to ``aliases``, if new.

    An id that several vocabularies have belongs to ``first``.
    """
    owner = kb.groupBy("candidate_id").agg(F.min(F.struct((F.col("vocabulary") != first).alias("later"), "vocabulary")).alias("o"))
    added = gold.join(owner, "candidate_id").groupBy("candidate_id", F.col("o.vocabulary").alias("vocabulary")).agg(in_order(F.col("text"), F.col("ord")).alias("more"))
    out = kb.join(added, ["candidate_id", "vocabulary"], "left")
    return out.withColumn("n_added", F.size(F.array_except(F.coalesce("more", F.array().cast("array<string>")), "aliases"))).withColumn("aliases", F.array_union("aliases", F.coalesce("more", F.array().cast("array<string>")))).drop("more")
