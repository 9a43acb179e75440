"""Quality of predicted spans against gold ones, of rankings, and of token labels.

Spans are (document_id, start, end, type, text, candidates, assertions, ord);
``ord`` is a span's place in its list, predictions also have a confidence.
Exact matches are joins.  The greedy matches depend on the order of a
document's spans: those of each document and type are one row of lists.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from functools import lru_cache, partial
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import similarity as S
from .spans import meeting

KEY = ["document_id", "start", "end", "type"]


def _counts(tp: DataFrame, gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row of counts and figures from a row with ``tp``."""
    row = tp.crossJoin(F.broadcast(gold.agg(F.count(F.lit(1)).alias("g_")))).crossJoin(F.broadcast(predicted.agg(F.count(F.lit(1)).alias("p_"))))  # one row each
    row = row.select(F.coalesce("tp", F.lit(0)).cast("long").alias("true_positive"), (F.col("p_") - F.coalesce("tp", F.lit(0))).cast("long").alias("false_positive"), (F.col("g_") - F.coalesce("tp", F.lit(0))).cast("long").alias("false_negative"))
    return row.withColumns(S.prf(F.col("true_positive"), F.col("false_positive"), F.col("false_negative")))


def exact_metrics(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Figures of spans with equal bounds and type, as bags: of repeated spans as many match as both sides have."""
    both = gold.groupBy(*KEY).agg(F.count(F.lit(1)).alias("g")).join(predicted.groupBy(*KEY).agg(F.count(F.lit(1)).alias("p")), KEY)
    return _counts(both.agg(F.sum(F.least("g", "p")).alias("tp")), gold, predicted)


def strict_matches(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Gold spans beside predictions with equal bounds and type, the n-th of equal ones beside the n-th."""
    nth = F.row_number().over(W.partitionBy(*KEY).orderBy("ord"))
    return _beside(gold.withColumn("n_", nth), predicted.withColumn("n_", nth), [*KEY, "n_"])


def _beside(gold: DataFrame, predicted: DataFrame, on: list[str]) -> DataFrame:
    g = gold.select(*on, *(F.col(c).alias(f"gold_{c}") for c in ("text", "candidates", "assertions")))
    p = predicted.select(*on, *(F.col(c).alias(f"pred_{c}") for c in ("text", "candidates", "assertions")))
    return g.join(p, on)


#: A span among those of its document and type: place in its list, bounds, text, confidence.
Span = tuple[int, int, int, str, float | None]


def _lists(column: pa.Array) -> list[list[tuple]]:
    """Rows of an array of structs as lists of tuples."""
    at = column.offsets.to_numpy()
    values = column.flatten()
    rows = list(zip(*(values.field(i).to_pylist() for i in range(values.type.num_fields)), strict=True))
    return [rows[lo:hi] for lo, hi in zip(at[:-1] - at[0], at[1:] - at[0], strict=True)]


#: Picks pairs of places in a list of gold spans and one of predicted spans.
Choice = Callable[[list[Span], list[Span]], list[tuple[int, int]]]


def _greedy(gold: DataFrame, predicted: DataFrame, choose: Choice, keep: tuple[str, ...] = ()) -> DataFrame:
    """(document_id, type, gold, pred): the pairs that ``choose`` picks among a document's spans of a type, both by ``ord``.

    Both sides are one table with a mark: a cogroup of two tables that come from
    one scan loses columns of the second.  Spans bring along the columns to
    ``keep``, so that pairs need no join.
    """

    def side(rows: DataFrame, is_gold: bool) -> DataFrame:
        confidence = F.lit(None) if is_gold else F.col("confidence")
        span = F.struct(F.col("ord").cast("long").alias("ord"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "text", confidence.cast("double").alias("confidence"), *keep)
        return rows.select("document_id", "type", F.lit(is_gold).alias("is_gold"), span.alias("span"))

    def run(g: pa.Array, p: pa.Array) -> pa.Array:
        return pa.array([[{"g": a, "p": b} for a, b in choose(x, y)] for x, y in zip(_lists(g), _lists(p), strict=True)], pa.list_(pa.struct([("g", pa.int32()), ("p", pa.int32())])))

    picked = F.arrow_udf(run, "array<struct<g: int, p: int>>")
    bare = lambda spans: F.transform(spans, lambda x: F.struct(*(x[c].alias(c) for c in ("ord", "start", "end", "text", "confidence")))) if keep else F.col(spans)
    own = lambda mark: F.sort_array(F.collect_list(F.when(mark, F.col("span"))))
    groups = side(gold, True).unionByName(side(predicted, False)).groupBy("document_id", "type").agg(own(F.col("is_gold")).alias("g"), own(~F.col("is_gold")).alias("p"))
    places = groups.where((F.size("g") > 0) & (F.size("p") > 0)).select("document_id", "type", "g", "p", picked(bare("g"), bare("p")).alias("k"))
    pairs = F.transform("k", lambda k: F.struct(F.col("g")[k["g"]].alias("gold"), F.col("p")[k["p"]].alias("pred")))
    return places.select("document_id", "type", F.inline(pairs))


def _ords(pairs: DataFrame) -> DataFrame:
    return pairs.select("document_id", "type", F.col("gold.ord").alias("gold_ord"), F.col("pred.ord").alias("pred_ord"))


class _Meeting:
    """Places in a list of spans of those that overlap a given one, in the list's order."""

    def __init__(self, spans: list[Span]):
        self.by_start = sorted((s, i, e) for i, (_, s, e, *_) in enumerate(spans))
        self.starts = [s for s, _, _ in self.by_start]
        self.longest = max((e - s for _, s, e, *_ in spans), default=0)

    def __call__(self, start: int, end: int) -> list[int]:
        lo, hi = bisect_right(self.starts, start - self.longest - 1), bisect_left(self.starts, end)
        return sorted(i for s, i, e in self.by_start[lo:hi] if min(e, end) > max(s, start))


def relaxed_pairs(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Predictions by falling confidence, each beside the unused gold span of its type that it overlaps most."""

    def choose(g: list[Span], p: list[Span]) -> list[tuple[int, int]]:
        near, used, out = _Meeting(g), set(), []
        for place, (_, s, e, _, _) in sorted(enumerate(p), key=lambda x: -inf if x[1][4] is None else x[1][4], reverse=True):
            best = max((i for i in near(s, e) if i not in used), key=lambda i: min(e, g[i][2]) - max(s, g[i][1]), default=None)
            if best is not None:
                used.add(best)
                out.append((best, place))
        return out

    return _ords(_greedy(gold, predicted, choose))


def relaxed_metrics(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    return _counts(relaxed_pairs(gold, predicted).agg(F.count(F.lit(1)).alias("tp")), gold, predicted)


@lru_cache(65_536)
def _word_errors(reference: str, hypothesis: str) -> float:
    ref, hyp = reference.split(), hypothesis.split()
    if not ref:
        return float(bool(hyp))
    row = list(range(len(hyp) + 1))
    for i, a in enumerate(ref, 1):
        left = [i]
        for j, b in enumerate(hyp, 1):
            left.append(min(row[j - 1] + (a != b), left[-1] + 1, row[j] + 1))
        row = left
    return row[-1] / len(ref)


class _Unused:
    """Places in a list, those not taken yet, in order."""

    def __init__(self) -> None:
        self.places: list[int] = []
        self.next = [0]  # the first place from each on that isn't taken

    def add(self, place: int) -> int:
        self.places.append(place)
        self.next.append(len(self.places))
        return len(self.places) - 1

    def take(self, k: int) -> None:
        self.next[k] = k + 1

    def first(self, besides: set[int]) -> int | None:
        k = 0
        while True:
            while self.next[k] != k:
                self.next[k] = k = self.next[self.next[k]]
            if k == len(self.places):
                return None
            if self.places[k] not in besides:
                return self.places[k]
            k += 1


#: Shares of place and words in how well a prediction fits.
PLACE, WORDS = 0.65, 0.35


def approximate_choice(g: list[Span], p: list[Span], least: float = 0.35) -> list[tuple[int, int]]:
    """Places of gold spans in order, each beside that of the unused prediction that fits best by place and words, if well enough.

    Predictions apart from a span fit by their words alone: of those with equal
    words only the first can be chosen, and where ``least`` asks for all that
    words give, only those with the span's own words.
    """
    near, free, out = _Meeting(p), [True] * len(p), []
    by_words: dict[tuple[str, ...], _Unused] = {}
    held = []
    for i, (_, _, _, text, _) in enumerate(p):
        same = by_words.setdefault(tuple(text.split()), _Unused())
        held.append((same, same.add(i)))
    for at, (_, s, e, t, _) in enumerate(g):
        best, most = None, 0.0
        close = [i for i in near(s, e) if free[i]]
        for i in close:
            _, start, end, text, _ = p[i]
            union = max(e, end) - min(s, start)
            place = PLACE * (max(0, min(e, end) - max(s, start)) / union if union else 0.0)
            if place + WORDS > most and (score := place + WORDS * max(0.0, 1 - _word_errors(t, text))) > most:
                best, most = i, score
        # spans apart from each other score this at most
        if most <= WORDS >= least:
            own = tuple(t.split())
            besides = set(close)
            for same in (by_words.values() if least < WORDS else [by_words[own]] if own in by_words else []):
                if (i := same.first(besides)) is not None and ((score := WORDS * max(0.0, 1 - _word_errors(t, p[i][3]))) > most or (best is not None and score == most and i < best)):
                    best, most = i, score
        if best is not None and most >= least:
            free[best] = False
            same, k = held[best]
            same.take(k)
            out.append((at, best))
    return out


def approximate_pairs(gold: DataFrame, predicted: DataFrame, least: float = 0.35) -> DataFrame:
    """Gold spans in order, each beside the unused prediction that fits best by place and words, if well enough."""
    return _ords(_greedy(gold, predicted, partial(approximate_choice, least=least)))


def approximate_matches(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    pairs = _greedy(gold, predicted, approximate_choice, ("candidates", "assertions"))
    beside = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("gold", "pred") for c in ("text", "candidates", "assertions")]
    return pairs.select("document_id", "type", F.col("gold.ord").alias("gold_ord"), F.col("pred.ord").alias("pred_ord"), *beside)


def competition_score(gold: DataFrame, predicted: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: text, assertion and candidate scores over the gold spans, and .3, .3 and .4 of them together."""
    matches = approximate_matches(gold, predicted) if approximate else strict_matches(gold, predicted)
    weight = F.greatest(F.lit(1), F.size("gold_candidates"))
    row = matches.agg(
        F.count(F.lit(1)).alias("matched"),
        F.sum(F.greatest(F.lit(0.0), 1 - S.word_error_rate(F.col("gold_text"), F.col("pred_text")))).alias("t"),
        F.sum(S.jaccard(F.col("gold_assertions"), F.col("pred_assertions"))).alias("a"),
        F.sum(S.jaccard(F.col("gold_candidates"), F.col("pred_candidates")) * weight).alias("c"),
    )
    sizes = gold.agg(F.count(F.lit(1)).alias("gold_entities"), F.sum(F.greatest(F.lit(1), F.size("candidates"))).alias("weights"))
    row = row.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(predicted.agg(F.count(F.lit(1)).alias("predicted_entities"))))  # one row each
    score = lambda part, whole: S.ratio(F.coalesce(part, F.lit(0.0)), F.coalesce(whole, F.lit(0)))
    t, a, c = score("t", "gold_entities"), score("a", "gold_entities"), score("c", "weights")
    return row.select("gold_entities", "predicted_entities", F.col("matched").alias("matched_entities"), F.round(t, 6).alias("text_score"), F.round(a, 6).alias("assertions_score"), F.round(c, 6).alias("candidates_score"), F.round(0.3 * t + 0.3 * a + 0.4 * c, 6).alias("final_score"))


def hits_at(ranked: DataFrame, gold: DataFrame, ks: tuple[int, ...] = (5, 10), key: str = "candidate_id") -> DataFrame:
    """One row: queries, the share that have a gold candidate in the first k, and the share whose first one is gold."""
    best = ranked.join(gold.select("query", key).distinct(), ["query", key]).groupBy("query").agg(F.min("rank").alias("best"))
    every = gold.select("query").distinct().join(best, "query", "left")
    shares = [F.round(S.ratio(F.count_if(F.col("best") <= k), F.count(F.lit(1))), 6).alias(f"hit_at_{k}") for k in ks]
    return every.agg(F.count(F.lit(1)).alias("queries"), *shares, F.round(S.ratio(F.count_if(F.col("best") == 1), F.count(F.lit(1))), 6).alias("linking_accuracy"))


def by_type(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Exact figures for each type."""
    both = gold.groupBy(*KEY).agg(F.count(F.lit(1)).alias("g")).join(predicted.groupBy(*KEY).agg(F.count(F.lit(1)).alias("p")), KEY, "full_outer").na.fill(0, ["g", "p"])
    rows = both.groupBy("type").agg(F.sum(F.least("g", "p")).alias("true_positive"), F.sum("p").alias("p"), F.sum("g").alias("g"))
    rows = rows.select("type", "true_positive", (F.col("p") - F.col("true_positive")).alias("false_positive"), (F.col("g") - F.col("true_positive")).alias("false_negative"))
    return rows.withColumns(S.prf(F.col("true_positive"), F.col("false_positive"), F.col("false_negative")))


def errors(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """(document_id, start, end, type, error): missed, spurious, wrong bounds (overlap, same type), wrong type (same bounds)."""
    g, p = gold.select(*KEY).distinct(), predicted.select(*KEY).distinct()
    missed, spurious = g.join(p, KEY, "left_anti"), p.join(g, KEY, "left_anti")
    other = spurious.select("document_id", F.col("start").alias("s_"), F.col("end").alias("e_"), F.col("type").alias("t_"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    near = meeting(missed.withColumns({"a_start": F.col("start"), "a_end": F.col("end")}), other, ["document_id"]).where(S.overlaps(F.col("start"), F.col("end"), F.col("s_"), F.col("e_")))
    same_bounds = (F.col("start") == F.col("s_")) & (F.col("end") == F.col("e_")) & (F.col("type") != F.col("t_"))
    kinds = near.groupBy(*KEY).agg(F.max(same_bounds).alias("wrong_type"), F.max(F.col("type") == F.col("t_")).alias("wrong_bounds"))
    kind = F.when(F.col("wrong_type"), "wrong type").when(F.col("wrong_bounds"), "wrong bounds").otherwise("missed")
    return missed.join(kinds, KEY, "left").select(*KEY, kind.alias("error")).unionByName(spurious.select(*KEY, F.lit("spurious").alias("error")))


def token_metrics(rows: DataFrame, label: Column | str = "label", predicted: Column | str = "predicted", outside: int = 0, ignored: int = -100) -> DataFrame:
    """One row of figures over the classes besides ``outside``, and the accuracy; labels ``ignored`` don't count."""
    y = F.col(label) if isinstance(label, str) else label
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    row = rows.where(y != ignored).agg(
        F.count_if((y == p) & (y != outside)).alias("true_positive"),
        F.count_if((p != outside) & (y != p)).alias("false_positive"),
        F.count_if((y != outside) & (y != p)).alias("false_negative"),
        S.ratio(F.count_if(y == p), F.count(F.lit(1))).alias("accuracy"),
    )
    return row.withColumns(S.prf(F.col("true_positive"), F.col("false_positive"), F.col("false_negative"))).withColumn("accuracy", F.round("accuracy", 6))
