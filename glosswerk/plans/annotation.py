"""Documents to annotated, linked and projected entities: the whole chain as one lazy plan."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import similarity as S
from ..functions import text as X
from ..operators import detect as D
from ..operators import retrieval as R
from ..operators import spans as P
from ..operators import submission as O
from ..sources.shared import written
from ..sources.writers import write_json


@dataclass(frozen=True)
class Settings:
    """Lexicons and limits of a run; the defaults are those of clinical notes."""

    rules: list = field(default_factory=lambda: L.RULES)
    headings: list = field(default_factory=lambda: L.SECTIONS)
    cues: dict = field(default_factory=lambda: L.CUES)
    relations: dict = field(default_factory=lambda: L.RELATIONS)
    vocabularies: dict = field(default_factory=lambda: L.VOCABULARIES)
    types: dict = field(default_factory=lambda: L.OFFICIAL_TYPES)
    medication_tail: str = L.MEDICATION_TAIL
    phrase_confidence: float = 0.94
    rule_confidence: float = 0.78
    most_words: int = 10
    prefix: int = 55
    width: int = 120
    most_distance: int = 256
    top_k: int = 10
    output_k: int | None = None
    least_score: float | None = None
    keep_detected: bool = False


def settings_of(path: str | None = None) -> Settings:
    """Settings of a JSON file, merged over the defaults; these alone if there is no file.

    Keys are the names of the fields; relations are lists [subject, object, relation].
    """
    file = None if path is None else Path(path)
    if file is None or not file.exists():
        return Settings()
    given = json.loads(file.read_text(encoding="utf-8"))
    names = {f.name for f in fields(Settings)}
    if unknown := sorted(set(given) - names):
        raise ValueError(f"{path}: unknown settings {unknown}")
    if "relations" in given:
        given["relations"] = {(s, o): r for s, o, r in given["relations"]}
    if "rules" in given:
        given["rules"] = [tuple(r) for r in given["rules"]]
    if "headings" in given:
        given["headings"] = [tuple(h) for h in given["headings"]]
    return Settings(**merged({n: getattr(Settings(), n) for n in names}, given))


def as_json(s: Settings) -> dict:
    """Settings as ``settings_of`` reads them."""
    return asdict(s) | {"relations": [[a, b, r] for (a, b), r in s.relations.items()]}


def write_artifacts(s: Settings, folder: str, models: dict[str, str] | None = None) -> list[str]:
    """A run's small JSON files on the driver: settings, output types, axes, relations, thresholds, and the models' state."""
    parts = {
        "config": as_json(s),
        "entity_type_mapping": {"drop_unmapped": True, "internal_to_official": s.types},
        "assertion_mapping": {"axes": {a: list(v) for a, v in X.AXIS_VALUES.items()}},
        "relation_mapping": {"compatible": as_json(s)["relations"], "most_distance": s.most_distance},
        "thresholds": {"dictionary_phrase": s.phrase_confidence, "rule": s.rule_confidence, "least_score": s.least_score},
        "model_status": models or {},
    }
    for name, payload in parts.items():
        write_json(f"{folder}/{name}.json", payload)
    return [f"{folder}/{name}.json" for name in parts]


def merged(base: dict, override: dict) -> dict:
    """``base`` with the values of ``override``; dictionaries are merged at every depth."""
    out = dict(base)
    for key, value in override.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def entities(docs: DataFrame, records: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Detected entities with resolved overlaps and refined bounds.  ``docs`` come from ``by_document``.

    Plain rules and a dictionary that Python can hold need one pass over each text; else each step is a table.
    """
    dictionary = D.phrases(records, s.most_words)
    if (at_once := D.entities_at_once(docs, dictionary, s.rules, s.most_words, s.phrase_confidence, s.rule_confidence, tail=s.medication_tail)) is not None:
        return at_once
    found = D.without_symptoms(D.dictionary_hits(docs, dictionary, s.most_words, s.phrase_confidence, tail=s.medication_tail), by_rule := D.rule_hits(docs, s.rules, s.rule_confidence))
    return P.refine_boundaries(P.resolve_overlaps(found.unionByName(by_rule)))


def ngram_ranks(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Stand-in for an embedding model: aliases ranked by the n-grams they share with the query.

    Pairs come from shared n-grams of three characters, not from all pairs.
    """

    def grams(rows: DataFrame, *keep: str) -> DataFrame:
        return rows.select(*keep, F.explode(S.ngrams(F.col("norm"), 3, 3)).alias("g"))

    c = corpus.withColumn("doc", F.concat_ws("#", "candidate_id", "place"))
    pairs = grams(queries, "query").join(grams(c, "doc"), "g").select("query", "doc").distinct()
    both = pairs.join(queries.select("query", F.col("norm").alias("q")), "query").join(c.select("doc", "candidate_id", "norm"), "doc")
    return R.top_k(both.withColumn("score", S.ngram_jaccard(F.col("q"), F.col("norm"))), ["query"], k, "doc")


def candidates(mentions: DataFrame, records: DataFrame, s: Settings = Settings(), semantic=ngram_ranks) -> DataFrame:
    """(vocabulary, norm, candidate_id, score, rank) of the distinct mentions (vocabulary, norm), by fused rankings.

    ``semantic`` ranks (query, norm) over aliases; an embedding model goes in here.
    """
    corpus = R.alias_corpus(records)
    out = None
    for vocabulary in sorted(set(s.vocabularies.values())):
        own = corpus.where(F.col("vocabulary") == vocabulary)
        asked = mentions.where(F.col("vocabulary") == vocabulary).select(F.col("norm").alias("query"), "norm").distinct()
        named = own.withColumn("doc", F.concat_ws("#", "candidate_id", "place"))
        by_word = R.bm25(named.select("doc", "norm"), asked, 5 * s.top_k).join(named.select("doc", "candidate_id"), "doc")
        fused = R.rrf(by_word, semantic(own, asked, 5 * s.top_k), s.top_k)
        fused = fused.select(F.lit(vocabulary).alias("vocabulary"), F.col("query").alias("norm"), "candidate_id", "score", "rank")
        out = fused if out is None else out.unionByName(fused)
    return out


def linked(found: DataFrame, records: DataFrame, s: Settings = Settings(), semantic=ngram_ranks) -> DataFrame:
    """Entities with their candidates; each distinct mention is looked up once."""
    mentions = found.select(R.vocabulary_of(F.col("type"), s.vocabularies).alias("vocabulary"), X.alias_key(F.col("text")).alias("norm")).where("vocabulary IS NOT NULL AND norm <> ''").distinct()
    mentions = written(mentions, "mentions")
    ranked = candidates(mentions, records, s, semantic)
    return R.link(found, ranked, records, s.vocabularies, s.output_k, s.least_score, s.keep_detected)


def annotated(docs: DataFrame, records: DataFrame, s: Settings = Settings(), semantic=ngram_ranks) -> DataFrame:
    """Entities with candidates, sections and axes.

    Detected entities are written to the shared folder once, since both the
    mentions to look up and the rows to link come from them.
    """
    found = linked(written(entities(docs, records, s), "entities"), records, s, semantic)
    return D.annotate(found, docs, P.sections(docs, s.headings), s.cues, s.prefix, s.width)


def submission(docs: DataFrame, records: DataFrame, s: Settings = Settings(), semantic=ngram_ranks) -> DataFrame:
    """Output rows of the whole chain."""
    return O.submission(annotated(P.by_document(docs), records, s, semantic), s.types)
