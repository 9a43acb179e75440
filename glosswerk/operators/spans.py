"""Table-generating text operators: matches, lines, sections, sentences, and choices among spans.

Documents are (document_id, raw_text).  Matches come from Python, which knows
their offsets, where the pattern means the same there; else from the two halves
of a regular expression's work, the matches and what lies between them, whose
lengths add up to the offsets by a running sum over the document.
``by_document`` deals the texts out once, before they are taken apart, and no
step after that moves rows.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions import text as X
from ..functions.similarity import overlaps


def within_document() -> WindowSpec:
    return W.partitionBy("document_id")



def by_document(docs: DataFrame) -> DataFrame:
    """Documents dealt out by id, as all operators of this module need them."""
    return docs.repartition("document_id")


#: Characters of texts whose matches are gathered at once.
MATCH_BLOCK = 1 << 20
LINE_END = r"\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}"
LINE, SENTENCE = rf"[^{LINE_END}]*(?:\r\n|[{LINE_END}])|[^{LINE_END}]+", r"[^.!?;\n]+[.!?;]*"
_PLAIN = re.compile(r"(?:[A-Za-z0-9 @_/%,:;=<>~\"'!#-]|\\[.+*?()\[\]{}|$^/-]|\[\^?(?:[A-Za-z0-9 @_/%,:;=<>+*?().!$#-])+\]|\((?:\?:|(?!\?))|[)|]|[*+?]|\{\d+(?:,\d*)?\})+")


def is_plain(pattern: str) -> bool:
    return bool(_PLAIN.fullmatch(pattern)) and "--" not in pattern


def in_python(pattern: str) -> str | None:
    """The pattern in Python's terms, where it is sure to match the same: those of this module, and plain ones.

    Plain patterns have literals, classes of ASCII, groups, alternatives and
    counts, and neither dots, borders, flags nor classes by name, whose meaning differs.
    """
    own = {X.TOKEN: r"\w+(?:[./-]\w+)*", LINE: LINE.replace(r"\x{2028}\x{2029}", "\u2028\u2029"), SENTENCE: SENTENCE}
    return own.get(pattern) or (pattern if is_plain(pattern) else None)


def _matches(pattern: str) -> Callable[[pa.Array], pa.Array]:
    """Matches (i, text, start, end) of each text."""
    find = re.compile(pattern).finditer

    def block(texts: list[str | None]) -> pa.Array:
        at, found, start = [0], [], []
        for t in texts:
            if t:
                for m in find(t):
                    found.append(m.group())
                    start.append(m.start())
            at.append(len(found))
        at, first = np.array(at, dtype=np.int32), np.array(start, dtype=np.int32)
        text = pa.array(found, pa.string())
        size = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int32)
        place = np.arange(len(found), dtype=np.int32) - np.repeat(at[:-1], np.diff(at))
        return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(place), text, pa.array(first), pa.array(first + size)], ["i", "text", "start", "end"]))

    def run(texts: pa.Array) -> pa.Array:
        parts, size, held = [], 0, []
        for t in texts.to_pylist():
            held.append(t)
            size += len(t or "")
            if size >= MATCH_BLOCK:
                parts.append(block(held))
                size, held = 0, []
        return pa.concat_arrays([*parts, block(held)])

    return run


def find_all(docs: DataFrame, pattern: str, text_col: str = "raw_text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(document_id, keep, i, text, start, end) of every match; the pattern must not match the empty text.

    Python knows a match's place, so one pass is enough; patterns that may mean
    something else there are left to Spark.
    """
    if (python := in_python(pattern)) is not None:
        found = F.arrow_udf(_matches(python), "array<struct<i: int, text: string, start: int, end: int>>")(F.col(text_col))
        return docs.select("document_id", *keep, found.alias("found_")).select("document_id", *keep, F.inline("found_"))
    own = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))
    between = F.split(F.col(text_col), pattern, -1)
    pairs = docs.where(F.rlike(F.col(text_col), F.lit(pattern))).select("document_id", *keep, F.posexplode(F.arrays_zip(own.alias("m"), between.alias("g"))).alias("i", "p"))
    last = F.sum(F.length("p.g") + F.length("p.m")).over(within_document().orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow))
    # the part after the last match has no match beside it
    rows = pairs.where("p.m IS NOT NULL").withColumn("end", last.cast("int"))
    return rows.select("document_id", *keep, "i", F.col("p.m").alias("text"), (F.col("end") - F.length("p.m")).alias("start"), "end")


def tokens(docs: DataFrame, pattern: str = X.TOKEN) -> DataFrame:
    """Words with inner dots, slashes and hyphens."""
    return find_all(docs, pattern)


def lines(docs: DataFrame) -> DataFrame:
    """Lines with their line ends."""
    return find_all(docs, LINE)


def trimmed(spans: DataFrame, left: str, right: str) -> DataFrame:
    """Spans without the characters that these classes match at their ends; spans of nothing else go."""
    lead = F.length(F.regexp_extract("text", rf"^{left}*", 0))
    tail = F.length(F.regexp_extract("text", rf"{right}*$", 0))
    out = spans.withColumn("lead", lead).where(F.col("lead") < F.length("text")).withColumn("tail", tail)
    out = out.withColumn("text", F.substring("text", F.col("lead") + 1, F.length("text") - F.col("lead") - F.col("tail")))
    return out.withColumn("start", F.col("start") + F.col("lead")).withColumn("end", F.col("end") - F.col("tail")).drop("lead", "tail")


_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def sentences(docs: DataFrame) -> DataFrame:
    """(document_id, sentence_id, text, start, end): runs up to ``.!?;`` or the line's end, trimmed."""
    found = trimmed(find_all(docs, SENTENCE), _SPACE, _SPACE)
    return found.withColumnRenamed("i", "sentence_id").select("document_id", "sentence_id", "text", "start", "end")


def sections(docs: DataFrame, headings: list[tuple[str, str]]) -> DataFrame:
    """(document_id, section_name, start, end): from each heading to the next one.

    What comes before the first heading is PREAMBLE; a text without headings is UNKNOWN.
    """
    found = lines(docs).withColumn("section_name", X.heading(F.col("text"), headings)).where("section_name IS NOT NULL").select("document_id", "section_name", "start")
    named = found.groupBy("document_id").agg(F.collect_list(F.struct("start", "section_name")).alias("found"), F.min("start").alias("first"))
    both = docs.select("document_id", F.length("raw_text").alias("size")).join(named, "document_id", "left")
    bounds = F.when(F.col("found").isNull(), F.array(F.struct(F.lit(0).alias("start"), F.lit("UNKNOWN").alias("section_name")))).when(
        F.col("first") > 0, F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit("PREAMBLE").alias("section_name"))), F.array_sort("found"))
    ).otherwise(F.array_sort("found"))
    rows = both.select("document_id", "size", F.explode(bounds).alias("b")).select("document_id", "size", "b.*")
    end = F.coalesce(F.lead("start").over(within_document().orderBy("start")), F.col("size"))
    return rows.withColumn("end", end).select("document_id", "section_name", "start", "end")


def with_section(spans: DataFrame, found: DataFrame) -> DataFrame:
    """Spans with the ``section_name`` of the section that contains them, else UNKNOWN.

    Sections don't overlap, so the one to look at is the last that starts at or before the span.
    """
    marks = found.select("document_id", F.col("start").alias("at"), F.lit(0).alias("kind"), F.struct("section_name", F.col("end").alias("until")).alias("sec"), F.lit(None).cast(spans.schema).alias("span"))
    rows = spans.select("document_id", F.col("start").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["sec"].dataType).alias("sec"), F.struct("*").alias("span"))
    last = F.last("sec", ignorenulls=True).over(within_document().orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow))
    inside = F.when(F.col("span.end") <= F.col("sec.until"), F.col("sec.section_name"))
    return marks.unionByName(rows).withColumn("sec", last).where("kind = 1").withColumn("section_name", F.coalesce(inside, F.lit("UNKNOWN"))).select("span.*", "section_name")


def with_sentence(spans: DataFrame, found: DataFrame) -> DataFrame:
    """Spans with the ``sentence_id`` of the sentence that contains them, or null."""
    marks = found.select("document_id", F.col("start").alias("at"), F.lit(0).alias("kind"), F.struct("sentence_id", F.col("end").alias("until")).alias("sen"), F.lit(None).cast(spans.schema).alias("span"))
    rows = spans.select("document_id", F.col("start").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["sen"].dataType).alias("sen"), F.struct("*").alias("span"))
    last = F.last("sen", ignorenulls=True).over(within_document().orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow))
    return marks.unionByName(rows).withColumn("sen", last).where("kind = 1").withColumn("sentence_id", F.when(F.col("span.end") <= F.col("sen.until"), F.col("sen.sentence_id"))).select("span.*", "sentence_id")


#: Columns that rank spans: the best first.
RANK = ("confidence", "end", "start", "type", "ord")


def resolve_overlaps(spans: DataFrame) -> DataFrame:
    """Spans chosen greedily: higher confidence, then longer, then earlier, then by type and ``ord``; none overlaps a better one.

    Only spans that overlap must be decided together.  A span that reaches past
    all earlier ones' ends starts a cluster, and each cluster is decided by
    itself, so a document's length doesn't matter.
    """
    columns = spans.columns
    before = F.max("end").over(within_document().orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    # a span of no length overlaps nothing that starts where it is
    fresh = F.when(F.coalesce(before <= F.col("start"), F.lit(True)), 1).otherwise(0)
    marked = spans.withColumn("fresh_", fresh)
    marked = marked.withColumn("cluster_", F.sum("fresh_").over(within_document().orderBy("start", "end").rowsBetween(W.unboundedPreceding, W.currentRow))).drop("fresh_")
    rank = F.struct((-F.col("confidence")).alias("r1"), (F.col("start") - F.col("end")).alias("r2"), F.col("start").alias("r3"), F.col("type").alias("r4"), F.col("ord").alias("r5"), F.struct(*(c for c in columns if c not in ("document_id",))).alias("span"))
    groups = marked.groupBy("document_id", "cluster_").agg(F.sort_array(F.collect_list(rank)).alias("ranked"))
    empty = F.filter(F.col("ranked"), lambda x: F.lit(False))

    def keep(kept: Column, x: Column) -> Column:
        clash = F.exists(kept, lambda y: overlaps(x["span"]["start"], x["span"]["end"], y["span"]["start"], y["span"]["end"]) | ((x["span"]["start"] == y["span"]["start"]) & (x["span"]["end"] == y["span"]["end"]) & (x["span"]["type"] == y["span"]["type"])))
        return F.when(clash, kept).otherwise(F.array_append(kept, x))

    chosen = F.when(F.size("ranked") == 1, F.col("ranked")).otherwise(F.aggregate("ranked", empty, keep))
    return groups.select("document_id", F.explode(chosen).alias("k")).select("document_id", "k.span.*").select(*columns)


def refine_boundaries(spans: DataFrame) -> DataFrame:
    """Spans cut at line ends, without white space and bullets at their ends, and resolved again."""
    columns = spans.columns
    parts = spans.withColumn("part_", F.split("text", "\n"))
    sizes = F.transform(F.col("part_"), lambda p: F.length(p) + 1)
    at = F.transform(F.col("part_"), lambda _, i: F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, x: a + x))
    rows = parts.withColumn("piece_", F.explode(F.arrays_zip(F.col("part_").alias("p"), at.alias("a")))).withColumn("text", F.col("piece_.p"))
    rows = rows.withColumn("start", (F.col("start") + F.col("piece_.a")).cast("int")).withColumn("end", (F.col("start") + F.length("text")).cast("int")).where("text <> ''")
    return resolve_overlaps(trimmed(rows.select(*columns), r"[\s\x1c-\x1f\x85\p{Z}\-*•+]", r"[\s\x1c-\x1f\x85\p{Z}\-*•+,;]").select(*columns))


#: A document's span in Python: start, end, text, type, candidate_id, confidence, mention_head, evidence, ord.
Span = tuple[int, int, str, str, str | None, float, str, str, int]
_BULLETS = "-*•+"


def _rank(x: Span) -> tuple:
    start, end, text, kind, code, confidence, head, evidence, place = x
    return (-confidence, start - end, start, kind, place, end, text, code is not None, code or "", head, evidence)


def resolved(spans: list[Span]) -> list[Span]:
    """``resolve_overlaps`` of one document's spans."""
    clusters, reach = [], None
    for x in sorted(spans, key=lambda x: x[:2]):
        if reach is None or reach <= x[0]:
            clusters.append([x])
            reach = x[1] if reach is None else max(reach, x[1])
        else:
            clusters[-1].append(x)
            reach = max(reach, x[1])
    out = []
    for cluster in clusters:
        if len(cluster) == 1:
            out.append(cluster[0])
            continue
        # bounds of the kept spans, in order; those of no length apart
        bounds, none = [], []
        for x in sorted(cluster, key=_rank):
            i = bisect_left(bounds, (x[1],))
            if (i and bounds[i - 1][1] > x[0]) or any((s < x[1] and x[0] < e) or (s, e, k) == (x[0], x[1], x[3]) for s, e, k in none):
                continue
            if x[0] < x[1]:
                insort(bounds, (x[0], x[1]))
            else:
                none.append((x[0], x[1], x[3]))
            out.append(x)
    return out


def refined(spans: list[Span]) -> list[Span]:
    """``refine_boundaries`` of one document's spans."""
    out = []
    for start, _, text, *more in spans:
        for part in text.split("\n"):
            lead = len(part) - len(part.lstrip(X.SPACES + _BULLETS))
            if lead < len(part):
                tail = len(part) - len(part.rstrip(X.SPACES + _BULLETS + ",;"))
                out.append((start + lead, start + len(part) - tail, part[lead : len(part) - tail], *more))
            start += len(part) + 1
    return resolved(out)


def token_windows(counts: DataFrame, size: int = 512, stride: int = 128) -> DataFrame:
    """(document_id, window, start, end) over ``n`` tokens: windows of ``size`` that share ``stride`` tokens."""
    if not 0 <= stride < size:
        raise ValueError("stride must be at least 0 and below size")
    step = size - stride
    # the last window is the first that reaches the end
    last = F.greatest(F.ceil((F.col("n") - size) / F.lit(step)), F.lit(0)).cast("int")
    rows = counts.where("n > 0").select("document_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("window"))
    start = F.col("window") * step
    return rows.select("document_id", "window", start.cast("int").alias("start"), F.least(start + size, F.col("n")).cast("int").alias("end"))


def meeting(a: DataFrame, b: DataFrame, on: list[str], cell: int = 256) -> DataFrame:
    """Rows of ``a`` beside rows of ``b`` with equal ``on`` whose spans share a cell of so many characters, each pair once.

    Spans are a_start, a_end and b_start, b_end, without their ends; spans of no
    length meet nothing.  What doesn't overlap must still be sorted out.  Rows
    meet by document and cell, so a document's length doesn't matter.
    """

    def placed(rows: DataFrame, side: str) -> DataFrame:
        first, last = F.floor(F.col(f"{side}_start") / cell), F.floor((F.col(f"{side}_end") - 1) / cell)
        return rows.where(F.col(f"{side}_start") < F.col(f"{side}_end")).withColumn(f"{side}_first", first).withColumn("cell", F.explode(F.sequence(f"{side}_first", last)))

    both = placed(a, "a").join(placed(b, "b"), [*on, "cell"])
    # the first cell that both are in
    return both.where(F.col("cell") == F.greatest("a_first", "b_first")).drop("cell", "a_first", "b_first", "a_start", "a_end", "b_start", "b_end")


def spans_to_bio(token_rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Tokens (document_id, i, start, end) with their BIO ``label``: B- at a span's first token, I- after it, O elsewhere.

    A token belongs to the first span, by start and end, that overlaps it; a
    token of no length has no label and ends no span.
    """
    near = spans.select("document_id", F.col("start").alias("s"), F.col("end").alias("e"), F.col("type").alias("t")).withColumns({"b_start": F.col("s"), "b_end": F.col("e")})
    hit = meeting(token_rows.select("document_id", "i", "start", "end", F.col("start").alias("a_start"), F.col("end").alias("a_end")), near, ["document_id"], 64)
    hit = hit.where(overlaps(F.col("start"), F.col("end"), F.col("s"), F.col("e")))
    first = hit.groupBy("document_id", "i").agg(F.min(F.struct("s", "e", "t")).alias("span"))
    rows = token_rows.join(first, ["document_id", "i"], "left")
    previous = F.lag("span").over(W.partitionBy("document_id", F.col("start") < F.col("end")).orderBy("i"))
    kind = F.when(F.col("span").isNull(), "O").when(previous == F.col("span"), F.concat(F.lit("I-"), F.col("span.t"))).otherwise(F.concat(F.lit("B-"), F.col("span.t")))
    return rows.withColumn("label", F.when(F.col("start") < F.col("end"), kind)).select("document_id", "i", "start", "end", "label")


def window_features(token_rows: DataFrame, spans: DataFrame, labels: DataFrame, size: int = 512, stride: int = 128, ignored: int = -100) -> DataFrame:
    """(document_id, window, first, offsets, label_ids): training rows of ``token_windows`` over tokens (document_id, i, start, end), i from 0.

    ``labels`` is (label, label_id); a label that it doesn't have is an error.
    Tokens of no length are ``ignored``.  A span that goes on from the window
    before begins anew.  A row holds ``size`` tokens at most.
    """
    windows = token_windows(token_rows.groupBy("document_id").agg((F.max("i") + 1).alias("n")), size, stride)
    step = size - stride
    # windows that a token can be in, by its place; the document's last window ends the list
    first = F.greatest(F.ceil((F.col("i") - size + 1) / F.lit(step)), F.lit(0)).cast("int")
    placed = spans_to_bio(token_rows, spans).withColumn("window", F.explode(F.sequence(first, F.greatest(F.floor(F.col("i") / step).cast("int"), first))))
    placed = placed.join(windows.select("document_id", "window", F.col("start").alias("first")), ["document_id", "window"])
    in_window = W.partitionBy("document_id", "window").orderBy("i")
    fresh = F.count("label").over(in_window) == 1
    placed = placed.withColumn("label", F.when(fresh & F.col("label").startswith("I-"), F.concat(F.lit("B-"), F.substring("label", 3, 1000))).otherwise(F.col("label")))
    placed = placed.join(F.broadcast(labels.select("label", "label_id")), "label", "left")  # two rows a type
    missing = F.raise_error(F.concat(F.lit("missing label: "), F.col("label"))).cast("int")
    number = F.when(F.col("label").isNull(), F.lit(ignored)).otherwise(F.coalesce("label_id", missing))
    token = F.struct("i", F.struct("start", "end").alias("o"), number.alias("l"))
    rows = placed.groupBy("document_id", "window", "first").agg(F.array_sort(F.collect_list(token)).alias("t"))
    return rows.select("document_id", "window", "first", F.transform("t", lambda x: x["o"]).alias("offsets"), F.transform("t", lambda x: x["l"]).alias("label_ids"))


_PLACED = "struct<i: int, start: int, end: int, label: string>"


def _spans_by_document(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents with their spans (start, end, type) in order, a list that can be null."""
    own = spans.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "type"))).alias("spans_"))
    return docs.join(own, "document_id", "left")


def _labels() -> Callable[[str | None, list[tuple[int, int, str]]], tuple[list[int], list[int], list[str]]]:
    """Bounds of a text's tokens, and their labels by its spans, which are in order."""
    find = re.compile(in_python(X.TOKEN)).finditer

    def run(text: str | None, spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int], list[str]]:
        bounds = [m.span() for m in find(text or "")]
        start, end = [a for a, _ in bounds], [b for _, b in bounds]
        first: dict[int, int] = {}  # token and the first span that overlaps it
        for k, (s, e, _) in enumerate(spans):
            i = bisect_right(end, s)
            # a span of no length has no token
            while i < len(start) and start[i] < e and s < e:
                first.setdefault(i, k)
                i += 1
        label = ["O"] * len(start)
        for i, k in first.items():
            label[i] = ("I-" if i - 1 in first and spans[first[i - 1]] == spans[k] else "B-") + spans[k][2]
        return start, end, label

    return run


def _unpacked(spans: pa.Array) -> list[list[tuple[int, int, str]]]:
    return [[(x["start"], x["end"], x["type"]) for x in row or ()] for row in spans.to_pylist()]


def documents_to_bio(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``spans_to_bio`` of the tokens of whole documents: a text is labelled at once, and no token is moved."""
    label_text = _labels()

    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        def block(rows: list[tuple]) -> pa.Array:
            at, place, start, end, label = [0], [], [], [], []
            for text, own in rows:
                a, b, names = label_text(text, own)
                place.extend(range(len(a)))
                start.extend(a)
                end.extend(b)
                label.extend(names)
                at.append(len(start))
            names = pa.array(label, pa.string())
            return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), names], ["i", "start", "end", "label"]))

        parts, size, held = [], 0, []
        for row in zip(texts.to_pylist(), _unpacked(found), strict=True):
            held.append(row)
            size += len(row[0] or "")
            if size >= MATCH_BLOCK:
                parts.append(block(held))
                size, held = 0, []
        return pa.concat_arrays([*parts, block(held)])

    labelled = F.arrow_udf(run, f"array<{_PLACED}>")
    return _spans_by_document(docs, spans).select("document_id", labelled("raw_text", "spans_").alias("l_")).select("document_id", F.inline("l_"))


def document_features(docs: DataFrame, spans: DataFrame, labels: DataFrame, size: int = 512, stride: int = 128) -> DataFrame:
    """``window_features`` of the tokens of whole documents: a text is labelled and cut into windows at once.

    ``labels`` has two rows a type and goes into the plan.
    """
    if not 0 <= stride < size:
        raise ValueError("stride must be at least 0 and below size")
    step, label_text = size - stride, _labels()
    number = {r["label"]: r["label_id"] for r in labels.select("label", "label_id").collect()}
    kind = pa.list_(pa.struct([("window", pa.int32()), ("first", pa.int32()), ("offsets", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("label_ids", pa.list_(pa.int32()))]))

    def id_of(label: str) -> int:
        if label not in number:
            raise ValueError(f"missing label: {label}")
        return number[label]

    def windows(text: str | None, own: list[tuple[int, int, str]]) -> list[dict]:
        start, end, label = label_text(text, own)
        ids, out = [id_of(x) for x in label], []
        for w in range(max(-(-(len(ids) - size) // step), 0) + 1 if ids else 0):
            lo = w * step
            part = ids[lo : lo + size]
            if label[lo].startswith("I-"):
                part[0] = id_of("B-" + label[lo][2:])
            out.append({"window": w, "first": lo, "offsets": [{"start": a, "end": b} for a, b in zip(start[lo : lo + size], end[lo : lo + size], strict=True)], "label_ids": part})
        return out

    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        parts, size_, held = [], 0, []
        for text, own in zip(texts.to_pylist(), _unpacked(found), strict=True):
            held.append(windows(text, own))
            size_ += len(text or "")
            if size_ >= MATCH_BLOCK:
                parts.append(pa.array(held, kind))
                size_, held = 0, []
        return pa.concat_arrays([*parts, pa.array(held, kind)])

    cut = F.arrow_udf(run, "array<struct<window: int, first: int, offsets: array<struct<start: int, end: int>>, label_ids: array<int>>>")
    return _spans_by_document(docs, spans).select("document_id", cut("raw_text", "spans_").alias("w_")).select("document_id", F.inline("w_"))


def bio_to_spans(labelled: DataFrame, docs: DataFrame) -> DataFrame:
    """Spans of BIO-labelled tokens (document_id, i, start, end, label, confidence), with their mean confidence."""
    seen = labelled.where("label IS NOT NULL AND start < end").withColumn("kind", F.substring("label", 1, 1)).withColumn("type", F.when(F.col("label") != "O", F.substring("label", 3, 1000)))
    order = within_document().orderBy("i")
    begins = (F.col("kind") == "B") | ~F.col("type").eqNullSafe(F.lag("type").over(order))
    runs = seen.withColumn("begin", F.when(begins, 1).otherwise(0)).withColumn("run", F.sum("begin").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))).where("type IS NOT NULL")
    spans = runs.groupBy("document_id", "run", "type").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.avg("confidence").alias("confidence"), F.min("i").alias("ord"))
    out = spans.join(docs.select("document_id", "raw_text"), "document_id")
    return out.select("document_id", "start", "end", X.piece(F.col("raw_text"), F.col("start"), F.col("end")).alias("text"), "type", "confidence", "ord")


#: Labels of texts' tokens, a list of words for each text: all labels in order, and their confidences.
TokenLabels = Callable[[pa.ListArray], tuple[pa.Array, pa.Array]]


@cache
def _word_characters() -> np.ndarray:
    """Whether each code point is one of Python's ``\\w``."""
    out = np.zeros(sys.maxunicode + 1, bool)
    for m in re.finditer(r"\w+", "".join(map(chr, range(len(out))))):
        out[m.start() : m.end()] = True
    return out


def in_blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of ``MATCH_BLOCK`` characters or little more, each with its first text's place."""
    size, lo = 0, 0
    for i, t in enumerate(texts, 1):
        size += len(t or "")
        if size >= MATCH_BLOCK or i == len(texts):
            yield lo, texts[lo:i]
            size, lo = 0, i


class Block:
    """Texts end to end with their tokens, as arrays; ``at`` is where each text begins, ``of`` the text of each token."""

    def __init__(self, texts: list[str | None]):
        whole = "\n".join(t or "" for t in texts)
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        inside = _word_characters()[code]
        # a dot, slash or hyphen between two word characters
        joint = (code[1:-1] >= ord("-")) & (code[1:-1] <= ord("/")) & inside[:-2] & inside[2:]
        inside[1:-1] |= joint
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edges[::2], edges[1::2]
        self.at = np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in texts])])
        self.first = np.searchsorted(self.start, self.at)  # each text's first token, and the number of tokens
        self.of = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.place = np.arange(len(self.start)) - self.first[self.of]
        self.data = np.frombuffer(whole.encode(), np.uint8)
        wide = (code >= 0x80).astype(np.int8) + (code >= 0x800) + (code >= 0x10000)
        self.byte = np.concatenate([[0], np.cumsum(wide, dtype=np.int64)]) + np.arange(len(code) + 1)

    def pieces(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """What lies between bounds, which are in order and don't overlap."""
        lo, hi = self.byte[start], self.byte[end]
        mark = np.zeros(len(self.data) + 1, np.int8)
        mark[lo] += 1
        mark[hi] -= 1
        data = self.data[np.cumsum(mark[:-1], dtype=np.int8).view(bool)]
        return pa.StringArray.from_buffers(len(lo), pa.py_buffer(np.concatenate([[0], np.cumsum(hi - lo)]).astype(np.int32)), pa.py_buffer(data))

    def words(self) -> pa.Array:
        return self.pieces(self.start, self.end)

    def spans(self, label: TokenLabels) -> tuple[np.ndarray, list[pa.Array]]:
        """The texts of the spans, and their start, end, text, type, confidence and ord."""
        labels, confidence = label(pa.ListArray.from_arrays(pa.array(self.first, pa.int32()), self.words()))
        coded = labels if pa.types.is_dictionary(labels.type) else labels.dictionary_encode()
        names = coded.dictionary.to_pylist()
        types = sorted({n[2:] for n in names if n is not None and n != "O"})
        # no label: -2; a label without a type: -1
        type_of = np.array([*(-2 if n is None else -1 if n == "O" else types.index(n[2:]) for n in names), -2])
        begins_of = np.array([*(n is not None and n.startswith("B") for n in names), False])
        index = coded.indices.fill_null(len(names)).to_numpy(zero_copy_only=False).astype(np.int64)
        seen = np.flatnonzero(type_of[index] > -2)
        kind, of = type_of[index[seen]], self.of[seen]
        before = np.where(np.diff(of, prepend=-1) != 0, -1, np.concatenate([[-1], kind[:-1]])) if len(kind) else kind
        begins = begins_of[index[seen]] | (kind != before)
        typed = kind >= 0
        at, begins = seen[typed], begins[typed]
        # a typed token that doesn't begin goes on from the one before it
        first = np.flatnonzero(begins)
        run = np.cumsum(begins) - 1
        last = np.concatenate([first[1:], [len(at)]]) - 1 if len(first) else first
        sure = confidence.cast(pa.float64()).is_valid().to_numpy(zero_copy_only=False)[at]
        values = confidence.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)[at]
        # sums in order, as the tokens come
        total, n = np.bincount(run, values, len(first)), np.bincount(run, sure, len(first))
        mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
        a, b = at[first], at[last]
        of = self.of[a]
        start, end = self.start[a], self.end[b]
        type_names = pa.array(types, pa.string()).take(pa.array(kind[typed][first]))
        ints = lambda x: pa.array(x, pa.int32())
        return of, [ints(start - self.at[of]), ints(end - self.at[of]), self.pieces(start, end), type_names, mean, ints(self.place[a])]


def documents_to_spans(docs: DataFrame, label: TokenLabels) -> DataFrame:
    """``bio_to_spans`` of the tokens of whole documents, labelled by ``label``: no token is moved, and no text is beside its spans."""
    kind = docs.schema["document_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["document_id", "start", "end", "text", "type", "confidence", "ord"]

        def block(ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
            of, columns = Block(texts).spans(label)
            return pa.RecordBatch.from_arrays([ids.take(pa.array(of)), *columns], names)

        for batch in batches:
            for lo, texts in in_blocks(batch.column(1).to_pylist()):
                yield block(batch.column(0).slice(lo, len(texts)), texts)

    return docs.select("document_id", "raw_text").mapInArrow(run, f"document_id {kind}, start int, end int, text string, type string, confidence double, ord int")


def bio_label_map(types: DataFrame) -> DataFrame:
    """(label, label_id) of the distinct types of a column ``type``: O, then B- and I- of each in order."""
    every = types.select("type").distinct().agg(F.sort_array(F.collect_set("type")).alias("t"))
    labels = F.concat(F.array(F.lit("O")), F.flatten(F.transform("t", lambda t: F.array(F.concat(F.lit("B-"), t), F.concat(F.lit("I-"), t)))))
    return every.select(F.posexplode(labels).alias("label_id", "label")).select("label", "label_id")
