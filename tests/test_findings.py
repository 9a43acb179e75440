"""What reviews found: each test failed before its change."""

import os
import random
import re
from math import log

import duckdb
import pyarrow as pa
import pytest
from comparing import SF_DIR, both, rows_of
from pyspark.sql import functions as F

from glosswerk.functions import text as X
from glosswerk.operators import detect as D
from glosswerk.operators import metrics as M
from glosswerk.operators import retrieval as R
from glosswerk.operators import spans as G
from glosswerk.plans import annotation as A
from glosswerk.plans import catalogue
from glosswerk.plans import setting as T

tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@tables
def test_relaxed_metrics_is_its_sql(spark):
    ours, theirs = both(spark, catalogue.QUERIES["relaxed_metrics"], catalogue.ORACLE_SQL["relaxed_metrics"])
    assert ours == theirs


def test_greedy_pairs_of_tables_from_one_scan(spark, tmp_path):
    """Against the plain loops over all pairs."""
    dice = random.Random(7)
    rows = [(str(d), i, s := dice.randrange(60), s + dice.randrange(9), dice.choice("XY"), " ".join(dice.choices("abc", k=dice.randrange(1, 4))), dice.random()) for d in range(12) for i in range(25)]
    spark.createDataFrame(rows, "document_id string, ord int, start int, end int, type string, text string, confidence double").write.parquet(f"{tmp_path}/spans")
    gold = spark.read.parquet(f"{tmp_path}/spans")
    predicted = gold.where("ord % 4 <> 0").withColumn("start", F.when(F.col("ord") % 3 == 0, F.col("start") + 1).otherwise(F.col("start"))).where("start <= end")
    relaxed, approximate = set(), set()
    p_rows = [tuple(r) for r in predicted.select("document_id", "ord", "start", "end", "type", "text", "confidence").collect()]
    for d, kind in {(r[0], r[4]) for r in rows}:
        g = sorted(r for r in rows if (r[0], r[4]) == (d, kind))
        p = sorted(r for r in p_rows if (r[0], r[4]) == (d, kind))
        shared = lambda a, b: min(a[3], b[3]) - max(a[2], b[2])
        free = list(g)
        for x in sorted(p, key=lambda r: -r[6]):
            best = max(free, key=lambda y: shared(x, y), default=None)
            if best is not None and shared(x, best) > 0:
                free.remove(best)
                relaxed.add((d, kind, best[1], x[1]))
        free = list(p)
        for x in g:
            best, most = None, 0.0
            for y in free:
                union = max(x[3], y[3]) - min(x[2], y[2])
                score = 0.65 * (max(0, shared(x, y)) / union if union else 0.0) + 0.35 * max(0.0, 1 - M._word_errors(x[5], y[5]))
                if score > most:
                    best, most = y, score
            if best is not None and most >= 0.35:
                free.remove(best)
                approximate.add((d, kind, x[1], best[1]))
    assert {tuple(r) for r in M.relaxed_pairs(gold, predicted).collect()} == relaxed
    assert {tuple(r) for r in M.approximate_pairs(gold, predicted).collect()} == approximate


@tables
def test_medication_beside_letters_beyond_ascii(spark, tmp_path):
    """A border of a word is where the SQL has it."""
    texts = ["ßIm Haus", "üim, 5 mg", "5 đơn vị", "5 đơn vịa", "x\vPO 7\vmg", "IM q8H", None, "poé 3 mgé", "5 Kg"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.sql(catalogue.ORACLE_SQL["medication_attributes"])
    df = catalogue.QUERIES["medication_attributes"](spark, str(tmp_path))
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


def test_patterns_that_mean_the_same_in_python():
    assert all(G.in_python(p) for p in (X.TOKEN, G.LINE, G.SENTENCE, *(r[1] for r in T.RULES)))
    assert not any(G.in_python(p) for p in (r"\bho\b", "a.b", "(?i)a", r"\s+", "[a&&[b]]", r"\p{L}", "^a", "a$", "[a--b]", "(?<=a)b", r"a\d"))


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_matches_in_one_pass_are_those_of_two_halves(spark, monkeypatch, block):
    """By the running sum of what lies between matches, and in one pass."""
    texts = ["", None, "a.b c-d/e f", "😀 Ünï thing 12 x@y.zz\n\nz", "\r\n\x85a b", "thing" * 30]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, raw_text string")
    monkeypatch.setattr(G, "MATCH_BLOCK", block)
    for pattern in (X.TOKEN, G.LINE, G.SENTENCE, *(r[1] for r in T.RULES)):
        ours = sorted(map(tuple, G.find_all(docs, pattern).collect()))
        with monkeypatch.context() as m:
            m.setattr(G, "in_python", lambda p: None)
            assert ours == sorted(map(tuple, G.find_all(docs, pattern).collect()))


def test_dictionary_hits_of_either_way(spark, monkeypatch):
    docs = spark.createDataFrame([("1", "Of THE thing, of the\nof of the STRASSE Straße to the is to en x to the"), ("2", "the.thing the thing"), ("3", None)], "document_id string, raw_text string")
    rows = [("DISEASE", "D1", ["thing", "the thing", "of of"]), ("DISEASE", "D2", ["of the", "of the thing", "straße"]), ("DRUG", "R1", ["to the", "thing"])]
    records = spark.createDataFrame([(t, c, a, i) for i, (t, c, a) in enumerate(rows)], "type string, candidate_id string, detection_aliases array<string>, ord int")
    found = lambda: sorted(map(str, D.dictionary_hits(docs, D.phrases(records), 5, tail=T.TAIL).collect()))
    ours = found()
    monkeypatch.setattr(D, "MOST_COLLECTED", 0)
    assert ours == found() and len(ours) >= 9


def test_labels_of_whole_documents_are_those_of_tokens(spark):
    docs = spark.createDataFrame([("1", "aa bb cc. dd ee-ff gg hh ii jj kk ll"), ("2", ""), ("3", None), ("4", "x y")], "document_id string, raw_text string")
    spans = spark.createDataFrame([("1", 0, 5, "X"), ("1", 4, 8, "Y"), ("1", 7, 7, "X"), ("1", 10, 12, "Y"), ("1", 14, 30, "X"), ("1", 14, 30, "X"), ("1", 31, 32, "Y")], "document_id string, start int, end int, type string")
    tokens = G.tokens(docs)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(G.documents_to_bio(docs, spans)) == rows(G.spans_to_bio(tokens, spans))
    labels = G.bio_label_map(spans)
    assert rows(G.document_features(docs, spans, labels, 4, 2)) == rows(G.window_features(tokens, spans, labels, 4, 2))
    with pytest.raises(Exception, match="missing label: B-X"):
        G.document_features(docs, spans, labels.where("label <> 'B-X'"), 4, 2).collect()


def test_bm25_against_plain_sums(spark):
    texts = [(1, "aa b aa cc"), (2, "aa dd"), (2, "cc"), (3, ""), (4, None), (5, "e f")]
    corpus = spark.createDataFrame(texts, "doc long, norm string")
    got = {(r["query"], r["doc"]): round(r["score"], 6) for r in R.bm25(corpus, spark.createDataFrame([(9, "aa cc zz b aa")], "query long, norm string"), 5).collect()}
    words = {}
    for d, t in texts:
        words.setdefault(d, []).extend(w for w in (t or "").split(" ") if len(w) >= 2)
    mean = sum(map(len, words.values())) / len(words)
    df = {w: sum(w in x for x in words.values()) for w in ("aa", "cc")}
    one = lambda d, w: log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5)) * words[d].count(w) * 2.5 / (words[d].count(w) + 1.5 * (0.25 + 0.75 * len(words[d]) / mean))
    assert got == {(9, d): round(sum(one(d, w) for w in df if w in words[d]), 6) for d in (1, 2)}


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_spans_of_whole_documents_are_those_of_labelled_tokens(spark, monkeypatch, block):
    monkeypatch.setattr(G, "MATCH_BLOCK", block)
    dice = random.Random(5)
    texts = ["", None, ".", "a", "a.b c-d/e f.-g", "😀 Ünï 𝟘𐐀/x 가\n\nz", *("".join(dice.choices("ab.-/ \né가́𐐀", k=dice.randrange(60))) for _ in range(60))]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, raw_text string")
    names = ["B-X", "I-X", "I-Y", "B-Y", "O", None, "I-X", "I-"]
    name_of = lambda w: names[sum(map(ord, w)) % 8]
    sure_of = lambda w: None if ord(w[0]) % 3 == 0 else ord(w[-1]) / 7

    def label(tokens):
        words = tokens.flatten().to_pylist()
        return pa.array(map(name_of, words), pa.string()), pa.array(map(sure_of, words), pa.float64())

    rows = [(r["document_id"], r["i"], r["start"], r["end"], name_of(r["text"]), sure_of(r["text"])) for r in G.tokens(docs).collect()]
    labelled = spark.createDataFrame(rows, "document_id string, i int, start int, end int, label string, confidence double")
    own = lambda df: sorted(map(str, df.withColumn("confidence", F.round("confidence", 9)).collect()))
    ours = own(G.documents_to_spans(docs, label))
    assert ours == own(G.bio_to_spans(labelled, docs)) and len(ours) > 100


def test_bio_islands_in_one_pass_is_its_sql(spark, tmp_path):
    """Also where composing shortens a token; nothing is joined or numbered by a window."""
    texts = ["한 ab 하x", "a.b c-d/e f", "ße Straße x", "", None, "of of of the then\nétés a", "word " * 300]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.sql(catalogue.ORACLE_SQL["bio_islands"])
    df = catalogue.QUERIES["bio_islands"](spark, str(tmp_path))
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())
    assert not any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Join", "Window"))


def test_entities_of_whole_documents_are_those_of_tables(spark, monkeypatch):
    """Chosen and refined in one pass, and step by step."""
    dice = random.Random(11)
    words = ["the", "thing", "Thing", "of the", "of of", "to the", "the-thing", "is to", "\n", "- ", ", x", "*thing +", "a@b.cc", "+49 (123) 4567-89", "Licensed under the MIT", "nicht", "STRAẞE", "straße", "😀", " ", "inoran inoran inoran"]
    texts = ["", None, "of of of of of", *(dice.choice([" ", "", "\n"]).join(dice.choices(words, k=dice.randrange(30))) for _ in range(120))]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, raw_text string")
    records = [("DISEASE", "D1", ["thing", "the thing", "of of"]), ("DISEASE", "D2", ["of the", "of the thing", "straße"]), ("DRUG", "R1", ["to the", "thing", "inoran inoran"])]
    table = spark.createDataFrame([(t, c, a, i) for i, (t, c, a) in enumerate(records)], "type string, candidate_id string, detection_aliases array<string>, ord int")
    rules = [*T.RULES, ("SYMPTOM", "[- ,+*\n]*of[ \n]+the[- ,+*\n]*", None), ("DISEASE", "[a-z]+\n[- a-z\n]+", "^[a-z][a-z]|x")]
    s = A.Settings(rules=rules, medication_tail=T.TAIL, most_words=5)
    own = lambda: sorted(map(str, A.entities(docs, table, s).select(*D.ENTITY).collect()))
    ours = own()
    assert D.entities_at_once(docs, D.phrases(table), [("SYMPTOM", r"\bho\b", None)], tail=T.TAIL) is None
    monkeypatch.setattr(D, "MOST_COLLECTED", 0)
    assert D.entities_at_once(docs, D.phrases(table), rules, tail=T.TAIL) is None
    assert ours == own() and len(ours) > 300


def test_approximate_choice_is_that_of_all_pairs():
    """However well a pair must fit; and many spans apart from all predictions are not compared with each of them."""

    def plain(g, p, least):
        free, out = dict.fromkeys(range(len(p))), []
        for at, (_, s, e, t, _) in enumerate(g):
            best, most = None, 0.0
            for i in free:
                _, start, end, text, _ = p[i]
                union = max(e, end) - min(s, start)
                score = 0.65 * (max(0, min(e, end) - max(s, start)) / union if union else 0.0) + 0.35 * max(0.0, 1 - M._word_errors(t, text))
                if score > most:
                    best, most = i, score
            if best is not None and most >= least:
                del free[best]
                out.append((at, best))
        return out

    dice = random.Random(3)
    spans = lambda: [(i, s := dice.randrange(60), s + dice.randrange(9), " ".join(dice.choices("abc", k=dice.randrange(4))), None) for i in range(dice.randrange(25))]
    for _ in range(200):
        g, p = spans(), spans()
        for least in (0.0, 0.2, 0.35, 0.6):
            assert M.approximate_choice(g, p, least) == plain(g, p, least)

    class Counted(list):
        looked = 0

        def __getitem__(self, i):
            self.looked += 1
            return super().__getitem__(i)

    g = [(i, 20 * i, 20 * i + 6, f"a b{i % 50}", None) for i in range(3000)]
    p = Counted(x if i % 3 else (i, 10**6 + i, 10**6 + i + 1, "z", None) for i, x in enumerate(g))
    M.approximate_choice(g, p)
    assert p.looked < 30_000


def test_competition_score_joins_no_spans(spark):
    """Matched spans bring along what is compared."""
    kind = "document_id string, ord int, start int, end int, type string, text string, candidates array<string>, assertions array<string>, confidence double"
    gold = spark.createDataFrame([("1", 0, 0, 3, "A", "a b", ["1"], ["x"], 1.0), ("1", 1, 5, 8, "A", "c d", ["2"], [], 1.0), ("2", 0, 0, 3, "A", "a", None, None, 1.0)], kind)
    predicted = spark.createDataFrame([("1", 7, 50, 53, "A", "c d", ["3", "2"], [], 0.5), ("1", 9, 1, 3, "A", "b", ["1"], ["x", "y"], 0.5)], kind)
    rows = M.approximate_matches(gold, predicted)
    assert sorted((r["gold_ord"], r["pred_ord"], r["gold_candidates"], r["pred_candidates"], r["pred_assertions"]) for r in rows.collect()) == [(0, 9, ["1"], ["1"], ["x", "y"]), (1, 7, ["2"], ["3", "2"], [])]
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()


def test_alternatives_are_left_out_where_they_cannot_match():
    """Texts' matches are those of the whole pattern, and a pattern whose letters a text hasn't got isn't tried."""
    assert D._alternatives(r"a\(b|c[(|]d+e|(x|\)y[)])z{2}w|q?r*st|a+b\?c") == [(r"a\(b", "a(b"), ("c[(|]d+e", "c"), (r"(x|\)y[)])z{2}w", "w"), ("q?r*st", "st"), (r"a+b\?c", "b?c")]
    dice, tried = random.Random(2), 0
    while tried < 1500:
        parts = [dice.choice(["a", "b", "c", "@", r"\.", r"\(", r"\)", "[ab]", "[^c(]", "(a|b)", "(?:ab|c)", r"(?:a(b|\))c)", "|"]) + dice.choice(["", "", "*", "+", "?", "{2}", "+?"]) for _ in range(dice.randrange(1, 7))]
        pattern = "".join("|" if p[0] == "|" else p for p in parts)
        if not G.is_plain(pattern):
            continue
        tried += 1
        find = D._finder(pattern)
        for _ in range(3):
            text = "".join(dice.choices("abc@.() ", k=dice.randrange(12)))
            assert [m.span() for m in find(text)] == [m.span() for m in re.finditer(pattern, text)], (pattern, text)
    assert D._finder("[Tt]hing|x@y")("no such letters") == ()
