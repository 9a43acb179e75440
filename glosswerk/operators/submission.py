"""Output: entities as the closed schema asks for, their validation, and a run's summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicons import OFFICIAL_KEYS, OFFICIAL_TYPES

KEYS = ("text", "type", "position", "assertions", "candidates")


def typed(entities: DataFrame, types: dict[str, str] = OFFICIAL_TYPES) -> DataFrame:
    """Entities with their ``official_type``; null where the type isn't an output type."""
    return entities.withColumn("official_type", X.official_type(F.col("type"), types))


def wants(kind: Column, key: str) -> Column:
    return kind.isin(*(k for k, keys in OFFICIAL_KEYS.items() if key in keys))


def submission(entities: DataFrame, types: dict[str, str] = OFFICIAL_TYPES) -> DataFrame:
    """(document_id, text, type, position, assertions, candidates), without types that aren't output types.

    ``entities`` has start, end, text, type, the four axes and candidates.  A key
    that a type doesn't have is null, and absent in JSON.
    """
    rows = typed(entities, types).where("official_type IS NOT NULL")
    labels = X.axis_labels(*(F.col(a) for a in X.AXIS_VALUES))
    kind = F.col("official_type")
    return rows.select(
        "document_id",
        "text",
        kind.alias("type"),
        F.array("start", "end").alias("position"),
        F.when(wants(kind, "assertions"), F.array_distinct(X.official_assertions(labels))).alias("assertions"),
        F.when(wants(kind, "candidates"), F.array_distinct(F.coalesce("candidates", F.array().cast("array<string>")))).alias("candidates"),
    )


def dropped(entities: DataFrame, types: dict[str, str] = OFFICIAL_TYPES) -> DataFrame:
    """(type, n): entities that ``submission`` leaves out."""
    return typed(entities, types).where("official_type IS NULL").groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def as_documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(document_id, payload): each document's entities by position as a JSON array; documents without any have ``[]``."""
    item = F.struct(*KEYS)
    place = F.struct(F.col("position")[0].alias("s"), F.col("position")[1].alias("e"), F.col("type").alias("t"), item.alias("item"))
    grouped = rows.groupBy("document_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["item"])).alias("payload"))
    return docs.select("document_id").join(grouped, "document_id", "left").select("document_id", F.coalesce("payload", F.lit("[]")).alias("payload"))


def diagnostics(entities: DataFrame, docs: DataFrame) -> DataFrame:
    """(document_id, payload): every column of each document's entities, and ``position``, by start, end and type, as a JSON array.

    Unlike in ``as_documents``, types that aren't output types stay, and nulls are written.
    """
    rows = entities.withColumn("position", F.array("start", "end"))
    item = F.struct(*sorted(c for c in rows.columns if c != "document_id"))
    line = F.to_json(item, {"ignoreNullFields": "false"})
    place = F.struct("start", "end", "type", line.alias("line"))
    grouped = rows.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["line"]), ",").alias("lines"))
    return docs.select("document_id").join(grouped, "document_id", "left").select("document_id", F.concat(F.lit("["), F.coalesce("lines", F.lit("")), F.lit("]")).alias("payload"))


def validate(payloads: DataFrame, docs: DataFrame) -> DataFrame:
    """(document_id, i, error) of whatever is wrong with the JSON of (document_id, payload); empty if all is well."""
    both = payloads.join(docs.select("document_id", "raw_text"), "document_id", "left").withColumn("v", F.try_parse_json("payload"))
    is_list = F.startswith(F.schema_of_variant("v"), F.lit("ARRAY"))
    not_list = both.where(~F.coalesce(is_list, F.lit(False))).select("document_id", F.lit(None).cast("int").alias("i"), F.lit("not an array").alias("error"))
    items = both.where(is_list).select("document_id", "raw_text", F.posexplode(F.expr("variant_get(v, '$', 'array<variant>')")).alias("i", "item"))
    items = items.withColumn("json", F.to_json("item")).withColumn("keys", F.json_object_keys("json")).withColumn("type", F.expr("try_variant_get(item, '$.type', 'string')"))
    expected = X.mapping_of_lists({k: [*KEYS[:3], *v] for k, v in OFFICIAL_KEYS.items()})
    items = items.withColumn("expected", F.try_element_at(expected, "type"))
    place = F.expr("try_variant_get(item, '$.position', 'array<int>')")
    items = items.withColumn("position", place).withColumn("text", F.expr("try_variant_get(item, '$.text', 'string')"))
    items = items.withColumn("assertions", F.expr("try_variant_get(item, '$.assertions', 'array<string>')")).withColumn("candidates", F.expr("try_variant_get(item, '$.candidates', 'array<string>')"))
    has = lambda key: F.array_contains("expected", key)
    allowed = F.array(F.lit("isNegated"), F.lit("isHistorical"), F.lit("isFamily"))
    start, end = F.try_element_at("position", F.lit(1)), F.try_element_at("position", F.lit(2))
    valid_place = F.coalesce(F.size("position") == 2, F.lit(False))
    errors = F.when(F.col("keys").isNull(), F.array(F.lit("not an object"))).when(F.col("expected").isNull(), F.array(F.lit("unsupported type"))).otherwise(
        F.array_compact(
            F.array(
                F.when((F.size(F.array_except("expected", "keys")) > 0) | (F.size(F.array_except("keys", "expected")) > 0), "invalid keys"),
                F.when(~valid_place, "invalid position").when(~X.offsets_valid(F.col("raw_text"), start, end, F.col("text")), "offset mismatch"),
                F.when(has("candidates") & F.col("candidates").isNull(), "candidates must be a list"),
                F.when(has("assertions") & F.col("assertions").isNull(), "assertions must be a list").when(has("assertions") & (F.size(F.array_except("assertions", allowed)) > 0), "unsupported assertions"),
            )
        )
    )
    return items.select("document_id", "i", F.explode(errors).alias("error")).unionByName(not_list)


def relabel(entities: DataFrame, types: dict[str, str] = OFFICIAL_TYPES) -> DataFrame:
    """Entities with official types as internal ones, in the column ``type``."""
    return entities.withColumn("type", X.internal_type(F.col("type"), types))


def complete(outputs: DataFrame, docs: DataFrame) -> DataFrame:
    """(document_id, state): documents without output (missing) and outputs without a document (extra)."""
    a, b = docs.select("document_id", F.lit(1).alias("a_")), outputs.select("document_id", F.lit(1).alias("b_"))
    both = a.join(b, "document_id", "full_outer").where("a_ IS NULL OR b_ IS NULL")
    return both.select("document_id", F.when(F.col("b_").isNull(), "missing").otherwise("extra").alias("state"))


def summary(entities: DataFrame, docs: DataFrame, related: DataFrame) -> DataFrame:
    """One row: documents, entities, linked, relations, output entities, entities of other types, offset errors."""
    checked = typed(entities).join(docs.select("document_id", "raw_text"), "document_id")
    valid = X.offsets_valid(F.col("raw_text"), F.col("start"), F.col("end"), F.col("text"))
    row = checked.agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.size(F.coalesce("candidates", F.array().cast("array<string>"))) > 0).alias("linked"),
        F.count("official_type").alias("submitted"),
        F.count_if(F.col("official_type").isNull()).alias("unmapped"),
        F.count_if(~valid).alias("offset_errors"),
    )
    return docs.agg(F.count(F.lit(1)).alias("documents")).crossJoin(F.broadcast(row)).crossJoin(F.broadcast(related.agg(F.count(F.lit(1)).alias("relations"))))  # one row each
