"""Learned models as plug-ins: token classifiers, rerankers and assertion models.

The library has no model of its own.  A caller gives a loader, which runs once
in each Python worker, and gets back what the model says as columns; the steps
around the model are column functions.  A worker's model goes with the worker,
so a later stage with a larger model starts with free memory.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .spans import bio_to_spans, resolve_overlaps

#: Takes texts and returns for each a list of (start, end, label, confidence) of its tokens.
TokenClassifier = Callable[[list[str]], list[list[tuple[int, int, str, float]]]]
#: Takes prompts and returns the answers.
Generator = Callable[[list[str]], list[str]]


def batches_of(rows: list, size: int) -> Iterator[list]:
    """Slices of a list, all but the last of one size."""
    if size <= 0:
        raise ValueError("size must be positive")
    for lo in range(0, len(rows), size):
        yield rows[lo : lo + size]


def classify_tokens(docs: DataFrame, load: Callable[[], TokenClassifier], batch: int = 32) -> DataFrame:
    """(document_id, i, start, end, label, confidence) of a token classifier over whole texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            for part in batches_of(list(frame.itertuples(index=False, name=None)), batch):
                said = model([t for _, t in part])
                rows = [(d, i, *token) for (d, _), tokens in zip(part, said, strict=True) for i, token in enumerate(tokens)]
                yield pd.DataFrame(rows, columns=["document_id", "i", "start", "end", "label", "confidence"])

    kind = dict(docs.dtypes)["document_id"]
    return docs.select("document_id", "raw_text").mapInPandas(run, f"document_id {kind}, i int, start int, end int, label string, confidence double")


def model_entities(docs: DataFrame, load: Callable[[], TokenClassifier], batch: int = 32) -> DataFrame:
    """Spans of a token classifier, overlaps between its windows resolved."""
    return resolve_overlaps(bio_to_spans(classify_tokens(docs, load, batch), docs))


def generate(rows: DataFrame, prompt: Column, load: Callable[[], Generator], batch: int = 64, name: str = "answer") -> DataFrame:
    """Rows with a generator's answer to a prompt made from each."""
    columns = rows.columns
    asked = rows.withColumn("prompt_", prompt)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            answers = [a for part in batches_of(frame["prompt_"].tolist(), batch) for a in model(part)]
            yield frame.drop(columns="prompt_").assign(**{name: answers})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{name}` string"])
    return asked.select(*columns, "prompt_").mapInPandas(run, schema)


def sampling_options(kind: Callable, schema: str, temperature: float = 0.0, most_tokens: int = 100, wrappers: dict[str, Callable] | None = None) -> dict:
    """Keyword arguments of a generator's sampling class ``kind`` that make its answers follow a JSON schema.

    ``wrappers`` are the classes that hold a schema, by the argument that takes
    them, in order of choice; the first whose argument ``kind`` has is taken.
    Without any, answers are free, and ``X.selected_id`` checks them as ever.
    """
    options = {"temperature": temperature, "max_tokens": most_tokens}
    takes = inspect.signature(kind).parameters
    for name, wrap in (wrappers or {}).items():
        if name in takes:
            return options | {name: wrap(json=schema)}
    return options


def rerank(linked: DataFrame, docs: DataFrame, load: Callable[[], Generator], names: DataFrame, batch: int = 64, width: int = 50) -> DataFrame:
    """Linked entities whose candidates a generator chose from: its choice alone, or the first one if it has none."""
    key = ["document_id", "start", "end", "type"]
    named = linked.select(*key, F.posexplode("candidates").alias("place", "candidate_id")).join(names.select("candidate_id", F.col("canonical_name").alias("name")).dropDuplicates(["candidate_id"]), "candidate_id", "left")
    lists = named.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "candidate_id", "name"))), lambda x: F.struct(x["candidate_id"].alias("candidate_id"), x["name"].alias("name"))).alias("listed"))
    rows = linked.join(lists, key).join(docs.select("document_id", "raw_text"), "document_id")
    rows = rows.withColumn("context", X.context(F.col("raw_text"), F.col("start"), F.col("end"), width)).drop("raw_text")
    said = generate(rows, X.rerank_prompt(F.col("text"), F.col("context"), F.col("listed")), load, batch)
    chosen = F.coalesce(X.selected_id(F.col("answer"), F.col("candidates")), F.col("candidates")[0])
    out = said.withColumn("warning", X.selection_warning(F.col("answer"), F.col("candidates"))).withColumn("candidates", F.array(chosen))
    none = linked.join(lists.select(*key), key, "left_anti").withColumn("warning", F.lit(None).cast("string"))
    return out.select(*linked.columns, "warning").unionByName(none.select(*linked.columns, "warning"))


def model_axes(entities: DataFrame, docs: DataFrame, load: Callable[[], Generator], batch: int = 64, width: int = 120) -> DataFrame:
    """Entities with the four axes as a generator states them; what it gets wrong is the default."""
    rows = entities.join(docs.select("document_id", "raw_text"), "document_id")
    rows = rows.withColumn("context", X.context(F.col("raw_text"), F.col("start"), F.col("end"), width)).drop("raw_text")
    said = generate(rows, X.assertion_prompt(F.col("text"), F.col("context")), load, batch)
    kept = [c for c in entities.columns if c not in X.AXIS_VALUES]
    return said.select(*kept, *(c.alias(a) for a, c in X.parsed_axes(F.col("answer")).items()))
