"""Column functions that compare texts, sets and vectors, and quality figures from counts."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and their harmonic mean from counts, to six places."""
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": F.round(ratio(2 * p * r, p + r), 6)}


def jaccard(left: Column, right: Column) -> Column:
    """Similarity of two arrays as sets; 1 if both are empty."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / F.greatest(union, F.lit(1)))


def tokens_of(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda t: t != "")


def token_jaccard(left: Column, right: Column) -> Column:
    """Similarity of two normalised texts by their words."""
    return jaccard(tokens_of(left), tokens_of(right))


def ngrams(normalized: Column, least: int = 2, most: int = 5) -> Column:
    """Distinct n-grams of characters; a space counts as an underscore."""
    text = F.replace(normalized, F.lit(" "), F.lit("_"))

    def of(size: int) -> Column:
        last = F.length(text) - size
        starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i + 1, F.lit(size)))

    return F.array_distinct(F.concat(*(of(n) for n in range(least, most + 1))))


def ngram_jaccard(left: Column, right: Column) -> Column:
    """Similarity of two normalised texts by their n-grams of 2 to 5 characters."""
    return jaccard(ngrams(left), ngrams(right))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, which Spark has no function for."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() if a is not None and b is not None else None for a, b in zip(left, right, strict=True)], dtype="float64")


def lexical_score(query: Column, alias: Column) -> Column:
    return 0.45 * sequence_ratio(query, alias) + 0.25 * token_jaccard(query, alias) + 0.30 * ngram_jaccard(query, alias)


def word_distance(left: Column, right: Column) -> Column:
    """Levenshtein distance of two arrays of words, one row of the table at a time."""
    start = F.transform(F.concat(F.array(F.lit("")), right), lambda _, j: j)

    def row(before: Column, word: Column) -> Column:
        # cells of a row depend on the one to their left: each is appended to those before it
        first = F.array(before[0] + 1)
        steps = F.transform(right, lambda w, j: F.struct(w.alias("w"), before[j].alias("diagonal"), before[j + 1].alias("above")))
        return F.aggregate(steps, first, lambda acc, s: F.array_append(acc, F.least(s["diagonal"] + F.when(s["w"] == word, 0).otherwise(1), s["above"] + 1, F.element_at(acc, -1) + 1)))

    return F.element_at(F.aggregate(left, start, row), -1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\s\x1c-\x1f\x85\p{Z}]+"), lambda t: t != "")


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Word distance over the reference's words; without any, 0 if the other has none either, else 1."""
    ref, hyp = words_of(reference), words_of(hypothesis)
    return F.when(reference == hypothesis, 0.0).when(F.size(ref) == 0, F.when(F.size(hyp) == 0, 0.0).otherwise(1.0)).otherwise(word_distance(ref, hyp) / F.greatest(F.size(ref), F.lit(1)))


def inner_product(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def overlap_length(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start < b_end) & (b_start < a_end)


def gap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Characters between two spans; 0 if they touch or overlap."""
    return F.greatest(F.lit(0), b_start - a_end, a_start - b_end)
