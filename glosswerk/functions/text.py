"""Column functions over text.  Offsets are half-open and count code points."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lexicons import CUES, MEDICATION, MEDICATION_TAIL, OFFICIAL_ASSERTIONS, OFFICIAL_TYPES, WORD

TOKEN = rf"{WORD}+(?:[./-]{WORD}+)*"
#: What Python's str.isspace calls white space.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def mapping(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def mapping_of_lists(pairs: dict[str, list[str]]) -> Column:
    return F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), F.array(*(F.lit(i) for i in v)))))


@cache
def unfolded() -> tuple[dict[str, str], dict[str, str]]:
    """Lower-case characters that case folding changes: to one other character, and to several."""
    changed = {c: f for c in map(chr, range(sys.maxunicode + 1)) if (f := c.casefold()) != c and c.lower() == c}
    return {c: f for c, f in changed.items() if len(f) == 1}, {c: f for c, f in changed.items() if len(f) > 1}


def fold(text: Column) -> Column:
    """Unicode's full case folding, without Python: lower case, then the characters that folding changes beyond that."""
    single, several = unfolded()
    lower = F.lower(text)
    one = F.translate(lower, "".join(single), "".join(single.values()))
    spelt = F.array_join(F.transform(F.split(one, ""), lambda c: F.coalesce(F.try_element_at(mapping(several), c), c)), "")
    # of one byte each are ASCII's characters alone, for which lower case is all
    return F.when(F.octet_length(text) == F.length(text), lower).when(F.rlike(one, F.lit(f"[{''.join(several)}]")), spelt).otherwise(one)


def normalize_alias(text: Column) -> Column:
    """Folded words joined by single spaces; for text in NFC (tokens have no combining marks, so this does for them)."""
    return F.trim(F.regexp_replace(fold(text), rf"[^\p{{L}}\p{{N}}_]+", " "))


#: What isn't a word; Python's ``\w`` is letters, numbers and the underscore of all scripts.
_BETWEEN = re.compile(r"\W+")


def alias_of(text: str) -> str:
    """``alias_key`` of one text."""
    return _BETWEEN.sub(" ", unicodedata.normalize("NFC", text).casefold()).strip(" ")


@F.arrow_udf(T.StringType())
def alias_key(text: pa.Array) -> pa.Array:
    """``normalize_alias`` of text that may be decomposed: dictionaries, mentions and queries are looked up by this."""
    return pa.array((None if t is None else alias_of(t) for t in text.to_pylist()), pa.string())


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition, which Spark has no function for."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


_MAPPED = T.StructType([T.StructField("model_text", T.StringType()), T.StructField("model_to_raw", T.ArrayType(T.IntegerType()))])


@F.pandas_udf(_MAPPED)
def normalize_with_mapping(text: pd.Series) -> pd.DataFrame:
    """Each character composed and folded by itself, white space runs as one space, and where each came from."""

    def one(raw: str) -> tuple[str, list[int]]:
        out, at, space = [], [], False
        for i, c in enumerate(raw):
            for x in unicodedata.normalize("NFC", c).casefold():
                if x.isspace():
                    if not space:
                        out.append(" ")
                        at.append(i)
                    space = True
                else:
                    out.append(x)
                    at.append(i)
                    space = False
        return "".join(out), at

    return pd.DataFrame([one(t) if t is not None else (None, None) for t in text], columns=["model_text", "model_to_raw"])


def raw_span(mapped: Column, raw_text: Column, start: Column, end: Column) -> Column:
    """Span of the raw text for one of the model text (a struct of ``normalize_with_mapping``)."""
    to_raw, size = mapped["model_to_raw"], F.length(mapped["model_text"])
    at = F.coalesce(F.try_element_at(to_raw, start + 1), F.length(raw_text))
    span = F.when(start == end, F.struct(at.alias("start"), at.alias("end"))).otherwise(F.struct(at.alias("start"), (F.try_element_at(to_raw, F.greatest(end, F.lit(1))) + 1).alias("end")))
    return F.when((start < 0) | (start > end) | (end > size), F.raise_error(F.lit("span is out of range"))).otherwise(span)


def heading(line: Column, sections: list[tuple[str, str]]) -> Column:
    """Name of the first heading that a line starts with, or null."""
    stripped = F.btrim(F.regexp_replace(line, r"[\r\n]+$", ""), F.lit(" \t:-"))
    out = F.lit(None).cast("string")
    for name, pattern in reversed(sections):
        out = F.when(F.rlike(stripped, F.lit(pattern)), F.lit(name)).otherwise(out)
    return out


def piece(text: Column, start: Column, end: Column) -> Column:
    """The text between two offsets."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def context(text: Column, start: Column, end: Column, width: int) -> Column:
    """A span with so many characters on both sides."""
    return piece(text, F.greatest(start - width, F.lit(0)), F.least(end + width, F.length(text)))


def prefix(text: Column, start: Column, width: int) -> Column:
    """The characters before an offset."""
    return piece(text, F.greatest(start - width, F.lit(0)), start)


def marked(text: Column, start: Column, end: Column, width: int = 160) -> Column:
    """A span's context with the span between ``<ENT>`` and ``</ENT>``."""
    after = piece(text, end, F.least(end + width, F.length(text)))
    return F.concat(prefix(text, start, width), F.lit("<ENT>"), piece(text, start, end), F.lit("</ENT>"), after)


def offsets_valid(text: Column, start: Column, end: Column, span_text: Column) -> Column:
    """Whether a span lies in the text and says what the text says there."""
    return F.coalesce((start >= 0) & (start <= end) & (end <= F.length(text)) & (piece(text, start, end) == span_text), F.lit(False))


def first_place(text: Column, pattern: str) -> Column:
    """Offset of the first match, or the text's length."""
    return F.length(F.split(text, pattern, 2)[0])


def medication_attributes(text: Column, patterns: dict[str, str] = MEDICATION) -> Column:
    """Name, strength, route, frequency and dose form of a medication."""
    name = F.btrim(F.substring(text, F.lit(1), F.least(*(first_place(text, p) for p in patterns.values()))), F.lit(" ,;:-"))
    found = {k: F.when(F.rlike(text, F.lit(p)), F.regexp_extract(text, p, 0)) for k, p in patterns.items()}
    return F.struct(F.when(name != "", name).otherwise(F.btrim(text, F.lit(SPACES))).alias("drug_name"), *(c.alias(k) for k, c in found.items()))


def extended_end(text: Column, end: Column, most: int = 96, tail: str = MEDICATION_TAIL) -> Column:
    """End of a drug's span with the attributes that follow it in the line, within so many characters."""
    rest = F.split(F.substring(text, end + 1, F.lit(most)), "\n", 2)[0]
    return end + F.length(F.regexp_extract(rest, tail, 0))


def natural_key(document_id: Column) -> list[Column]:
    """Sort keys: ids of digits by number first, all others after them by name."""
    number = F.when(F.rlike(document_id, F.lit(r"^\d+$")), document_id.try_cast("decimal(38,0)"))
    return [F.coalesce(number, F.lit(10**12).cast("decimal(38,0)")), document_id]


def official_type(kind: Column, types: dict[str, str] = OFFICIAL_TYPES) -> Column:
    return F.try_element_at(mapping(types), kind)


def internal_type(kind: Column, types: dict[str, str] = OFFICIAL_TYPES) -> Column:
    """Official types as internal ones; others as they are."""
    return F.coalesce(F.try_element_at(mapping({v: k for k, v in types.items()}), kind), kind)


def axis_labels(polarity: Column, temporality: Column, certainty: Column, experiencer: Column) -> Column:
    named = zip(("polarity", "temporality", "certainty", "experiencer"), (polarity, temporality, certainty, experiencer), strict=True)
    return F.array(*(F.concat(F.lit(f"{n}:"), c) for n, c in named))


def official_assertions(labels: Column, names: dict[str, str] = OFFICIAL_ASSERTIONS) -> Column:
    return F.array_compact(F.transform(labels, lambda x: F.try_element_at(mapping(names), x)))


def axes(prefix_text: Column, context_text: Column, section: Column, cues: dict[str, str] = CUES) -> dict[str, Column]:
    """Polarity, temporality, certainty and experiencer of a mention by the cues around it."""

    def has(text: Column, cue: str) -> Column:
        return F.rlike(text, F.lit(cues[cue]))

    past = section.isin("HISTORY", "FAMILY_HISTORY") | has(context_text, "historical")
    return {
        "polarity": F.when(has(prefix_text, "negated"), "NEGATED").otherwise("AFFIRMED"),
        "temporality": F.when(has(context_text, "planned"), "PLANNED").when(has(context_text, "resolved"), "RESOLVED").when(past, "HISTORICAL").otherwise("CURRENT"),
        "certainty": F.when(has(context_text, "possible"), "POSSIBLE").otherwise("CONFIRMED"),
        "experiencer": F.when((section == "FAMILY_HISTORY") | has(prefix_text, "family"), "FAMILY").otherwise("PATIENT"),
    }


def json_object(text: Column) -> Column:
    """The JSON object in a model's answer (fenced, or from the first brace to the last) as text; null if there is none."""
    fenced = F.regexp_extract(text, r"(?is)```(?:json)?\s*(\{.*\})\s*```", 1)
    found = F.when(fenced != "", fenced).otherwise(F.regexp_extract(text, r"(?s)\{.*\}", 0))
    return F.when(F.startswith(F.schema_of_variant(F.try_parse_json(found)), F.lit("OBJECT")), found)


def selected_id(answer: Column, candidate_ids: Column) -> Column:
    """The id that an answer selects, if it is one of the candidates."""
    chosen = F.get_json_object(json_object(answer), "$.selected_id")
    return F.when(F.array_contains(candidate_ids, chosen), chosen)


def selection_warning(answer: Column, candidate_ids: Column) -> Column:
    """Why an answer selects nothing, unless it says so itself."""
    found = json_object(answer)
    chosen = F.get_json_object(found, "$.selected_id")
    return (
        F.when(found.isNull(), "not a JSON object")
        .when(~F.array_contains(F.coalesce(F.json_object_keys(found), F.array().cast("array<string>")), "selected_id"), "missing selected_id")
        .when(chosen.isNotNull() & ~F.array_contains(candidate_ids, chosen), "unknown selected_id")
    )


def rerank_prompt(mention: Column, context_text: Column, candidates: Column) -> Column:
    """Chat prompt that asks for one of the candidates (array of structs candidate_id, name)."""
    listed = F.array_join(F.transform(candidates, lambda c: F.concat(F.lit("- "), c["candidate_id"], F.lit(": "), F.coalesce(c["name"], F.lit("")))), "\n")
    return F.concat(
        F.lit("<|im_start|>system\nChoose the code that fits the mention. Answer with JSON: {\"selected_id\": id or null}.<|im_end|>\n<|im_start|>user\nMention: "),
        mention, F.lit("\nContext: "), context_text, F.lit("\nCandidates:\n"), listed, F.lit("<|im_end|>\n<|im_start|>assistant\n"),
    )


def choice_schema(ids: Column) -> Column:
    """JSON schema of an answer that chooses one of some ids, or null; ids that are numbers stay numbers."""
    listed = F.substring(F.to_json(ids), F.lit(2), F.length(F.to_json(ids)) - 2)
    enum = F.concat_ws(",", F.when(F.size(ids) > 0, listed), F.lit("null"))
    return F.concat(F.lit('{"type":"object","properties":{"selected_id":{"enum":['), enum, F.lit(']}},"required":["selected_id"]}'))


def assertion_prompt(mention: Column, context_text: Column) -> Column:
    """Chat prompt that asks for the four axes of a mention."""
    return F.concat(
        F.lit("<|im_start|>system\nState polarity, temporality, certainty and experiencer of the mention as one JSON object.<|im_end|>\n<|im_start|>user\nMention: "),
        mention, F.lit("\nContext: "), context_text, F.lit("<|im_end|>\n<|im_start|>assistant\n"),
    )


#: Values that an answer may have for each axis; the first is the default.
AXIS_VALUES = {
    "polarity": ("AFFIRMED", "NEGATED"),
    "temporality": ("CURRENT", "HISTORICAL", "PLANNED", "RESOLVED"),
    "certainty": ("CONFIRMED", "POSSIBLE"),
    "experiencer": ("PATIENT", "FAMILY"),
}


def parsed_axes(answer: Column) -> dict[str, Column]:
    """Axes of a model's answer; whatever it gets wrong is the default."""
    found = json_object(answer)
    out = {}
    for axis, values in AXIS_VALUES.items():
        value = F.get_json_object(found, f"$.{axis}")
        out[axis] = F.when(value.isin(*values), value).otherwise(F.lit(values[0]))
    return out


def icd_code(display: Column) -> Column:
    """Code without its marks (dagger, asterisk)."""
    return F.trim(F.regexp_replace(display, "[†*]", ""))


def icd_markers(display: Column) -> Column:
    return F.regexp_extract_all(display, F.lit("([†*])"))


def cell_text(cell: Column) -> Column:
    return F.btrim(F.coalesce(cell.cast("string"), F.lit("")), F.lit(SPACES))
