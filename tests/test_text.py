"""Column functions and span operators against values worked out by hand, and Python's own text functions."""

import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from glosswerk.functions import lexicons as L
from glosswerk.functions import similarity as S
from glosswerk.functions import text as X
from glosswerk.operators import spans as P


def docs(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, raw_text string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_normalize_alias(spark):
    texts = ["  Tăng-HUYẾT  áp! ", "Straße", "a_b", "", "x² ½"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(X.normalize_alias(X.nfc(F.col("t"))).alias("n")).collect()
    python = [re.sub(r"\s+", " ", re.sub(r"[^\w]+", " ", unicodedata.normalize("NFC", t).casefold())).strip() for t in texts]
    assert [r["n"] for r in rows] == python
    assert python[0] == "tăng huyết áp"


def test_nfc_composes(spark):
    assert one(spark, X.nfc(F.lit("é"))) == "é"


def test_mapping_back(spark):
    raw = "A  Ǆß\tb"
    m = X.normalize_with_mapping(F.lit(raw))
    row = spark.range(1).select(m.alias("m")).select("m.model_text", "m.model_to_raw", X.raw_span(F.col("m"), F.lit(raw), F.lit(2), F.lit(4)).alias("s"), X.raw_span(F.col("m"), F.lit(raw), F.lit(1), F.lit(1)).alias("e")).first()
    assert row["model_text"] == "a " + "Ǆ".casefold() + "ss b"
    assert (row["s"]["start"], row["s"]["end"]) == (3, 5)
    assert (row["e"]["start"], row["e"]["end"]) == (1, 1)


def test_tokens_and_offsets(spark):
    texts = ["a-b c", "", "😀x 12/3 é.", "-.-"]
    got = P.tokens(docs(spark, *texts)).orderBy("document_id", "i").collect()
    want = [(str(d), m.group(), m.start(), m.end()) for d, t in enumerate(texts) for m in re.finditer(r"\b\w+(?:[./-]\w+)*\b", t)]
    assert [(r["document_id"], r["text"], r["start"], r["end"]) for r in got] == want


def test_sentences(spark):
    got = P.sentences(docs(spark, "A. B!\nC", "  \n . x;y ")).orderBy("document_id", "start").collect()
    assert [(r["document_id"], r["start"], r["end"]) for r in got] == [("0", 0, 2), ("0", 3, 5), ("0", 6, 7), ("1", 4, 5), ("1", 6, 8), ("1", 8, 9)]


def test_sections(spark):
    text = "Lý do\nTiền sử: sốt\nThuốc\naspirin\nTiền sử gia đình\nmẹ"
    got = P.sections(docs(spark, text, "không", ""), L.SECTIONS).orderBy("document_id", "start").collect()
    rows = [(r["document_id"], r["section_name"], r["start"], r["end"]) for r in got]
    a, b, c = text.index("Tiền"), text.index("Thuốc"), text.index("Tiền sử gia")
    assert rows == [("0", "PREAMBLE", 0, a), ("0", "HISTORY", a, b), ("0", "MEDICATIONS", b, c), ("0", "HISTORY", c, len(text)), ("1", "UNKNOWN", 0, 5), ("2", "UNKNOWN", 0, 0)]


def test_lines_are_splitlines(spark):
    text = "a\r\nb\rc\x0bd e\x85\n"
    got = P.lines(docs(spark, text)).orderBy("i").collect()
    assert [r["text"] for r in got] == text.splitlines(keepends=True)


SPAN = "document_id string, start int, end int, text string, type string, confidence double, ord int"


def spans(spark, text, *rows):
    return spark.createDataFrame([("0", s, e, text[s:e], k, c, i) for i, (s, e, k, c) in enumerate(rows)], SPAN)


def test_resolve_overlaps(spark):
    text = "0123456789abc"
    got = P.resolve_overlaps(spans(spark, text, (0, 5, "A", 0.94), (3, 9, "A", 0.94), (9, 11, "A", 0.78), (9, 11, "A", 0.78))).orderBy("start").collect()
    assert [(r["start"], r["end"], r["ord"]) for r in got] == [(3, 9, 1), (9, 11, 2)]


def greedy(rows):
    kept = []
    for s, e, k, c, i in sorted(rows, key=lambda r: (-r[3], r[0] - r[1], r[0], r[2], r[4])):
        if not any(s < y and x < e for x, y, *_ in kept) and (s, e, k) not in [(a, b, t) for a, b, t, *_ in kept]:
            kept.append((s, e, k, c, i))
    return sorted(kept)


def test_resolve_overlaps_is_the_greedy_choice_and_stable(spark):
    import random

    rng = random.Random(3)
    text = "x" * 60
    for parts in (1, 3):
        rows = [(s, s + rng.randint(1, 9), rng.choice("AB"), rng.choice([0.5, 0.9])) for s in (rng.randint(0, 50) for _ in range(40))]
        once = P.resolve_overlaps(spans(spark, text, *rows).repartition(parts))
        got = [(r["start"], r["end"], r["type"], r["confidence"], r["ord"]) for r in once.orderBy("start").collect()]
        assert got == greedy([(*r, i) for i, r in enumerate(rows)])
        assert once.exceptAll(P.resolve_overlaps(once)).isEmpty()


def test_refine_boundaries(spark):
    text = "x - ho,\n• sốt +\n\n-"
    got = P.refine_boundaries(spans(spark, text, (2, len(text), "S", 0.9))).orderBy("start").collect()
    assert [(r["text"], text[r["start"] : r["end"]]) for r in got] == [("ho", "ho"), ("sốt", "sốt")]


def test_windows(spark):
    counts = spark.createDataFrame([("a", 1000), ("b", 512), ("c", 0), ("d", 513)], "document_id string, n long")
    got = P.token_windows(counts).orderBy("document_id", "window").collect()
    assert [(r["document_id"], r["start"], r["end"]) for r in got] == [("a", 0, 512), ("a", 384, 896), ("a", 768, 1000), ("b", 0, 512), ("d", 0, 512), ("d", 384, 513)]
    with pytest.raises(ValueError):
        P.token_windows(counts, 4, 4)


def test_bio_round_trip(spark):
    d = docs(spark, "aa bb cc dd ee")
    tokens = P.tokens(d)
    found = spans(spark, "aa bb cc dd ee", (0, 5, "X", 1.0), (6, 8, "X", 1.0), (12, 14, "Y", 1.0))
    labels = P.spans_to_bio(tokens, found)
    assert [r["label"] for r in labels.orderBy("i").collect()] == ["B-X", "I-X", "B-X", "O", "B-Y"]
    back = P.bio_to_spans(labels.withColumn("confidence", F.lit(0.5)), d).orderBy("start").collect()
    assert [(r["start"], r["end"], r["type"], r["text"]) for r in back] == [(0, 5, "X", "aa bb"), (6, 8, "X", "cc"), (12, 14, "Y", "ee")]
    names = P.bio_label_map(spark.createDataFrame([("DRUG",), ("DISEASE",), ("DRUG",)], "type string")).collect()
    assert {r["label"]: r["label_id"] for r in names} == {"O": 0, "B-DISEASE": 1, "I-DISEASE": 2, "B-DRUG": 3, "I-DRUG": 4}


def test_medication(spark):
    got = one(spark, X.medication_attributes(F.lit("aspirin 81 mg po daily")))
    assert (got["drug_name"], got["strength"], got["route"], got["frequency"], got["dose_form"]) == ("aspirin", "81 mg", "po", "daily", None)
    assert one(spark, X.medication_attributes(F.lit(" po "))) ["drug_name"] == "po"
    text = "aspirin 81 mg po daily, rồi nghỉ"
    assert one(spark, X.extended_end(F.lit(text), F.lit(7))) == len("aspirin 81 mg po daily")
    assert one(spark, X.extended_end(F.lit("aspirin\n81 mg"), F.lit(7))) == 7


def test_axes(spark):
    text = "không sốt"
    a = X.axes(X.prefix(F.lit(text), F.lit(6), 55), X.context(F.lit(text), F.lit(6), F.lit(9), 120), F.lit("UNKNOWN"))
    row = spark.range(1).select(*(c.alias(k) for k, c in a.items())).first()
    assert tuple(row) == ("NEGATED", "CURRENT", "CONFIRMED", "PATIENT")
    labels = X.axis_labels(*(F.lit(v) for v in ("NEGATED", "HISTORICAL", "POSSIBLE", "FAMILY")))
    assert one(spark, X.official_assertions(labels)) == ["isNegated", "isHistorical", "isFamily"]


def test_answers(spark):
    ids = F.array(F.lit("K59.0"))
    fenced = F.lit('Sure:\n```json\n{"selected_id": "K59.0"}\n```')
    assert one(spark, X.selected_id(fenced, ids)) == "K59.0"
    assert one(spark, X.selected_id(F.lit("The best choice is K59.0."), F.array(F.lit("I10")))) is None
    assert one(spark, X.selection_warning(F.lit('{"selected_id": null}'), ids)) is None
    assert one(spark, X.selection_warning(F.lit('{"selected_id": "I10"}'), ids)) == "unknown selected_id"
    assert one(spark, X.selection_warning(F.lit("{}"), ids)) == "missing selected_id"
    assert one(spark, X.selection_warning(F.lit("no"), ids)) == "not a JSON object"
    answer = F.lit('```json\n{"polarity": "NEGATED", "temporality": "LATER", "certainty": "CONFIRMED", "experiencer": "PATIENT"}\n```')
    axes = X.parsed_axes(answer)
    assert (one(spark, axes["polarity"]), one(spark, axes["temporality"])) == ("NEGATED", "CURRENT")


def test_natural_order(spark):
    rows = spark.createDataFrame([("10",), ("a",), ("2",), ("02",)], "d string")
    assert [r["d"] for r in rows.orderBy(*X.natural_key(F.col("d"))).collect()] == ["02", "2", "10", "a"]


def test_icd_code(spark):
    assert one(spark, X.icd_code(F.lit("A01.0†"))) == "A01.0"
    assert one(spark, X.icd_markers(F.lit("A01.0†*"))) == ["†", "*"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = [i]
        for j, y in enumerate(b, 1):
            left.append(min(row[j - 1] + (x != y), left[-1] + 1, row[j] + 1))
        row = left
    return row[-1]


def test_similarities(spark):
    pairs = [("a b c d", "a x c"), ("", ""), ("", "a"), ("a", ""), ("tăng huyết áp", "huyết áp cao"), ("aa aa", "aa")]
    rows = spark.createDataFrame(pairs, "l string, r string")
    got = rows.select("l", "r", S.word_error_rate(F.col("l"), F.col("r")).alias("wer"), S.token_jaccard(F.col("l"), F.col("r")).alias("t"), S.ngram_jaccard(F.col("l"), F.col("r")).alias("n"), S.sequence_ratio("l", "r").alias("s")).collect()
    for r in got:
        a, b = r["l"].split(), r["r"].split()
        assert r["wer"] == pytest.approx(distance(a, b) / len(a) if a else float(bool(b)))
        sets = [(set(a), set(b)), tuple({t.replace(" ", "_")[i : i + n] for n in range(2, 6) for i in range(len(t) - n + 1)} for t in (r["l"], r["r"]))]
        for value, (x, y) in zip((r["t"], r["n"]), sets, strict=True):
            assert value == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
        assert r["s"] == pytest.approx(SequenceMatcher(None, r["l"], r["r"]).ratio())
    assert got[0]["wer"] == 0.5


def test_figures_without_counts(spark):
    zero = F.lit(0)
    assert [one(spark, c) for c in S.prf(zero, zero, zero).values()] == [0.0, 0.0, 0.0]
    assert one(spark, S.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 1.0
