"""License scan by canonical digest lookup.

A whole text is brought to a canonical form, and the SHA-256 of that form is
looked up in a table of digests of known license texts by a hash join.  The form
is made in one pass: lower case; copyright lines go, where a text has any; words
(runs of letters, marks and digits of any script) are taken out of what lies
between them, be it white space, ASCII or Unicode punctuation or a copyright
sign; each word of another spelling is replaced by one lookup; single spaces
join them.

The table has one row for each text of this library's list (a few hundred), so
it is broadcast; a longer list of the caller's own (``texts``, or a folder read by
``read_licenses``) is left to the planner.  The list has each license with and
without its usual title lines.  A license or notice inside a longer text isn't
found: only the whole text is looked up.

Defined results: a null text is the empty text, and no license; a text with
nothing but copyright lines and punctuation has an empty canonical form and no
license.  Repeated rows give repeated rows; if a caller's list has one
canonical text under several names, the smallest name counts.  An empty table
gives an empty table.  Only the id and text columns are read, so other columns
may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_library import more_texts
from .license_texts import LICENSES

#: Words that count as equal, as (spelling, canonical spelling).
SPELLINGS = [
    ("acknowledgment", "acknowledgement"),
    ("analog", "analogue"),
    ("analyze", "analyse"),
    ("artifact", "artefact"),
    ("authorization", "authorisation"),
    ("authorized", "authorised"),
    ("caliber", "calibre"),
    ("canceled", "cancelled"),
    ("cooperation", "co operation"),
    ("favor", "favour"),
    ("fulfill", "fulfil"),
    ("http", "https"),
    ("initialize", "initialise"),
    ("judgement", "judgment"),
    ("labeling", "labelling"),
    ("license", "licence"),
    ("licensed", "licenced"),
    ("noncommercial", "non commercial"),
    ("organization", "organisation"),
    ("owner", "holder"),
    ("owners", "holders"),
    ("recognized", "recognised"),
    ("sublicense", "sub licence"),
    ("utilization", "utilisation"),
    ("whilst", "while"),
    ("wilful", "willful"),
]
#: Lines that state a copyright, or that all rights are reserved; they differ from copy to copy.
COPYRIGHT_LINE = r"^[^a-z0-9\n]*(copyright( |\()[^\n]*|\(c\) [^\n]*|© ?[^\n]*|all rights reserved\.?[ ]*)$"
#: What every copyright line has, so that other texts aren't searched for them.
COPYRIGHT_SIGNS = ["copyright", "(c) ", "©", "all rights reserved"]
#: What lies between words.
BETWEEN = r"[^\p{L}\p{M}\p{N}]+"


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines; words joined by single spaces; one spelling."""
    lower = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\r"), F.lit("\n"))
    signs = F.contains(lower, F.lit(COPYRIGHT_SIGNS[0]))
    for sign in COPYRIGHT_SIGNS[1:]:
        signs = signs | F.contains(lower, F.lit(sign))
    body = F.when(signs, F.regexp_replace(lower, f"(?md){COPYRIGHT_LINE}", " ")).otherwise(lower)
    words = F.trim(F.regexp_replace(body, BETWEEN, " "))
    spelled = F.create_map(*(F.lit(x) for pair in SPELLINGS for x in pair))
    other = [spelling for spelling, _ in SPELLINGS]
    one = F.transform(F.split(words, " "), lambda w: F.when(w.isin(*other), F.try_element_at(spelled, w)).otherwise(w))
    return F.array_join(one, " ")


def read_licenses(spark: SparkSession, path: str) -> DataFrame:
    """(license_id, text) of a folder of ``<license_id>.txt`` files, a list for ``license_scan``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("license_id"), F.col("content").cast("string").alias("text"))


def known_digests(spark: SparkSession, texts: DataFrame | None = None) -> DataFrame:
    """(canonical_sha256, license_id) of ``texts`` (license_id, text), by default of the list of this library."""
    if texts is None:
        texts = spark.createDataFrame(sorted([*LICENSES.items(), *more_texts()]), "license_id string, text string")
    form = canonical(F.col("text"))
    return texts.select("license_id", form.alias("form")).where("form <> ''").groupBy(F.sha2(F.col("form").cast("binary"), 256).alias("canonical_sha256")).agg(F.min("license_id").alias("license_id"))


def license_scan(docs: DataFrame, texts: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_canonical, canonical_sha256, license_id (null: none known)."""
    known = known_digests(docs.sparkSession, texts)
    if texts is None:
        known = F.broadcast(known)  # a row for each text of this library's list
    forms = docs.select(F.col(id_col).alias("id"), canonical(F.col(text_col)).alias("form")).select("id", F.length("form").cast("long").alias("n_canonical"), F.sha2(F.col("form").cast("binary"), 256).alias("canonical_sha256"))
    return forms.join(known, "canonical_sha256", "left").select(F.col("id").alias(id_col), "n_canonical", "canonical_sha256", "license_id")
