"""The setting of the queries: dictionary, rules and cues that occur in the driver's documents, and adapters.

The default lexicons are of clinical notes; the driver's documents are invented
prose, so the queries pass lexicons of their own to the same operators.
Patterns here mean the same in Java and in RE2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicons import VOCABULARIES

#: (type, candidate_id, aliases); one phrase has two codes, and some aliases aren't admissible.
RECORDS = [
    ("DISEASE", "D01", ["thing", "the thing", "Thanedble the"]),
    ("DISEASE", "D02", ["of the", "orantion", "of of", "1234"]),
    ("DISEASE", "D03", ["in the", "ho", "abcd", "in the thtion"]),
    ("DISEASE", "D04", ["nicht", "der der", "and attion to thanedble"]),
    ("DISEASE", "D05", ["thble", "de de", "inoran inoran inoran"]),
    ("DRUG", "R01", ["thatin", "thtion", "to the"]),
    ("DRUG", "R02", ["nicht", "hehely hehely", "oning"]),
    ("DRUG", "R03", ["de la", "ering", "that the"]),
    ("DRUG", "R04", ["attion to", "la de", "rewh rewh"]),
]
MOST_WORDS = 5
#: What may follow a drug, and rules with their types.
TAIL = r"^(?:[ ,]+(?:is|to|that|are|en))+"
RULES = [
    ("SYMPTOM", r"[Tt]hing|[Oo]f the|[a-z0-9.]+@[a-z0-9.]+[a-z0-9]", None),
    ("LAB_RESULT", r"\+?[0-9][0-9() -]{6,}[0-9]", r"^\+?[0-9]"),
    ("PATIENT_INFO", r"(?:[Ll]icen[sc]ed|[Rr]eleased) under (?:the )?[A-Za-z]+", None),
]
CUES = {"negated": "(?:er|is) ", "historical": "(?:was|are) ", "planned": "(?:est|tion) to ", "resolved": " an? (?:the|of)", "possible": "ou[a-z]*ed", "family": "he(?:n|r) "}
HEADINGS = [("HISTORY", "^(?:the|der|de|la)(?:$|[^a-z])"), ("FAMILY_HISTORY", "^(?:en|an|in)(?:$|[^a-z])"), ("PLAN", "^(?:[A-Z][a-z]*tion)(?:$|[^a-z])"), ("LABS", "^(?:Th|Er|El)[a-z]* ")]

_ASCII = "[A-Za-z0-9_]"
#: The border of a word as RE2 has it, in Java's terms: Java's own also knows letters beyond ASCII.
BORDER = f"(?:(?<={_ASCII})(?!{_ASCII})|(?<!{_ASCII})(?={_ASCII}))"


def as_in_sql(words: str) -> str:
    """Java pattern that means what ``(?i)\\b(?:words)\\b`` means in the SQL, whose white space is ASCII without the vertical tab.

    Each alternative begins with a letter or a digit; where none can begin, the border isn't looked at.
    """
    first = "".join(sorted({w[0] if w[0] != "\\" else "0-9" for w in words.split("|")}))
    return f"(?=(?iu:[{first}])){BORDER}(?iu:{words.replace(chr(92) + 's', '[\\t\\n\\f\\r ]')}){BORDER}"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (document_id, raw_text); a null text is empty."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rows.select(F.col("doc_id").cast("string").alias("document_id"), F.coalesce("text", F.lit("")).alias("raw_text"))


def records(spark: SparkSession) -> DataFrame:
    """The dictionary as records of a knowledge base."""
    rows = [(VOCABULARIES[t], t, i, a[0], a, a, n) for n, (t, i, a) in enumerate(RECORDS)]
    return spark.createDataFrame(rows, "vocabulary string, type string, candidate_id string, canonical_name string, aliases array<string>, detection_aliases array<string>, ord int")
