"""Unicode lookups, training rows, answer schemas, settings and files, with values worked out by hand."""

import gzip
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from glosswerk.functions import lexicons as L
from glosswerk.functions import text as X
from glosswerk.operators import detect as D
from glosswerk.operators import knowledge as K
from glosswerk.operators import models as N
from glosswerk.operators import profile as P
from glosswerk.operators import retrieval as R
from glosswerk.operators import spans as G
from glosswerk.operators import submission as O
from glosswerk.plans import annotation as A
from glosswerk.sources import writers as W

SPAN = "document_id string, start int, end int, type string"
GOLD = "document_id string, subject_start int, subject_end int, subject_type string, object_start int, object_end int, object_type string, relation string"


def test_fold_is_case_folding(spark):
    chars = [chr(c) for lo, hi in ((0x20, 0x590), (0x13A0, 0x1400), (0x1E00, 0x2000), (0x2100, 0x2190), (0xFB00, 0xFB18)) for c in range(lo, hi)]
    chars = [c for c in chars if unicodedata.category(c) not in ("Cn", "Cc")] + ["Straße ΣΑΣ ﬁn İſ", "", None]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(chars)], "i int, c string").select("i", X.fold(F.col("c")).alias("f")).collect()
    assert {r["i"]: r["f"] for r in rows} == {i: c if c is None else c.casefold() for i, c in enumerate(chars)}


def test_decomposed_names_are_found(spark):
    apart = unicodedata.normalize("NFD", "Tăng HUYẾT áp")
    kb = spark.createDataFrame([("ICD10", "DISEASE", "I10", apart, [apart], [apart], 0)], "vocabulary string, type string, candidate_id string, canonical_name string, aliases array<string>, detection_aliases array<string>, ord int")
    docs = spark.createDataFrame([("1", "Bệnh: tăng huyết áp.")], "document_id string, raw_text string")
    assert [r["phrase"] for r in D.phrases(kb).collect()] == ["tăng huyết áp"]
    assert [r["text"] for r in D.dictionary_hits(docs, D.phrases(kb)).collect()] == ["tăng huyết áp"]
    assert [r["norm"] for r in R.alias_corpus(kb).collect()] == ["tăng huyết áp"]


def test_relation_examples(spark):
    entities = spark.createDataFrame([("1", 0, 4, "DRUG"), ("1", 10, 14, "DISEASE"), ("1", 10, 14, "DISEASE"), ("1", 400, 404, "DISEASE"), ("2", 0, 4, "DRUG")], SPAN)
    gold = spark.createDataFrame([("1", 0, 4, "DRUG", 10, 14, "DISEASE", "TREATS"), ("9", 0, 4, "DRUG", 10, 14, "DISEASE", "TREATS")], GOLD)
    rows = D.relation_examples(entities, gold).collect()
    assert {(r["document_id"], r["subject_start"], r["object_start"], r["label"], r["distance"]) for r in rows} == {("1", 0, 10, "TREATS", 6), ("1", 10, 0, "NO_RELATION", 6)}
    assert D.relation_examples(entities.limit(0), gold).count() == 0
    made = random.Random(5)
    spans = [("d", s := made.randrange(3000), s + made.randrange(1, 40), made.choice("AB")) for _ in range(80)]
    got = {tuple(r)[1:7] for r in D.relation_examples(spark.createDataFrame(spans, SPAN), gold).collect()}
    assert got == {a[1:] + b[1:] for a in spans for b in spans if a != b and max(0, b[1] - a[2], a[1] - b[2]) <= 256}


def test_window_features(spark):
    places = [(i * 3, i * 3 + 2) for i in range(11)]
    places[4] = (12, 12)  # of no length
    tokens = spark.createDataFrame([("1", i, s, e) for i, (s, e) in enumerate(places)], "document_id string, i int, start int, end int")
    spans = spark.createDataFrame([("1", 6, 20, "DRUG")], SPAN)
    labels = G.bio_label_map(spans)
    ids = {r["label"]: r["label_id"] for r in labels.collect()}
    got = {r["window"]: r for r in G.window_features(tokens, spans, labels, size=5, stride=2).collect()}
    want = {}
    for w, at in enumerate(range(0, 7, 3)):
        row, before = [], False
        for s, e in places[at : at + 5]:
            if s == e:
                row.append(-100)
                continue
            hit = s < 20 and 6 < e
            row.append(ids[("I-DRUG" if before else "B-DRUG") if hit else "O"])
            before = hit
        want[w] = row
    assert {w: r["label_ids"] for w, r in got.items()} == want
    assert got[1]["first"] == 3 and [tuple(o) for o in got[1]["offsets"]] == places[3:8]
    with pytest.raises(Exception, match="missing label"):
        G.window_features(tokens, spans, labels.where("label <> 'I-DRUG'")).collect()


def test_choice_schema_and_sampling(spark):
    rows = spark.createDataFrame([(["A", 'q"ê'],), ([],)], "ids array<string>").select(X.choice_schema(F.col("ids")).alias("s")).collect()
    assert [json.loads(r["s"])["properties"]["selected_id"]["enum"] for r in rows] == [["A", 'q"ê', None], [None]]
    number = spark.sql("SELECT array(1, 2) ids").select(X.choice_schema(F.col("ids"))).first()[0]
    assert json.loads(number) == {"type": "object", "properties": {"selected_id": {"enum": [1, 2, None]}}, "required": ["selected_id"]}
    both = {"structured_outputs": lambda json: ("s", json), "guided_decoding": lambda json: ("g", json)}
    free = {"temperature": 0.0, "max_tokens": 100}
    assert N.sampling_options(lambda temperature, max_tokens, guided_decoding: 0, "{}", wrappers=both) == free | {"guided_decoding": ("g", "{}")}
    assert N.sampling_options(lambda structured_outputs, guided_decoding: 0, "{}", wrappers=both) == free | {"structured_outputs": ("s", "{}")}
    assert N.sampling_options(lambda temperature: 0, "{}", wrappers=both) == N.sampling_options(lambda temperature: 0, "{}") == free


def test_settings(tmp_path):
    assert A.settings_of() == A.settings_of(str(tmp_path / "none.json")) == A.Settings()
    file = tmp_path / "s.json"
    file.write_text(json.dumps({"top_k": 3, "vocabularies": {"NEW": "X"}, "relations": [["A", "B", "R"]]}))
    s = A.settings_of(str(file))
    assert s.top_k == 3 and s.vocabularies == L.VOCABULARIES | {"NEW": "X"} and s.relations == L.RELATIONS | {("A", "B"): "R"}
    made = A.write_artifacts(s, str(tmp_path / "run"), {"ner": "absent"})
    assert len(made) == 6 and A.settings_of(str(tmp_path / "run" / "config.json")) == s
    assert W.read_json(str(tmp_path / "run" / "model_status.json")) == {"ner": "absent"}
    file.write_text('{"tok_k": 3}')
    with pytest.raises(ValueError, match="tok_k"):
        A.settings_of(str(file))


def test_document_files_and_diagnostics(spark, tmp_path):
    docs = spark.createDataFrame([("1", "ab cd"), ("2", "")], "document_id string, raw_text string")
    entities = spark.createDataFrame([("1", 3, 5, "cd", "Z", None), ("1", 0, 2, "ab", "A", 0.5)], "document_id string, start int, end int, text string, type string, confidence double")
    (tmp_path / "old.json").write_text("{}")
    (tmp_path / "kept.txt").write_text("")
    assert W.write_document_files(O.diagnostics(entities, docs), str(tmp_path)) == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["1.json", "2.json", "kept.txt"]
    first, second = W.read_json(str(tmp_path / "1.json"))
    assert first == {"confidence": 0.5, "end": 2, "position": [0, 2], "start": 0, "text": "ab", "type": "A"} and second["confidence"] is None
    assert W.read_json(str(tmp_path / "2.json")) == []
    with pytest.raises(Exception, match="file's name"):
        W.write_document_files(spark.createDataFrame([("../x", "[]")], "document_id string, payload string"), str(tmp_path))
    assert W.write_document_files(O.diagnostics(entities.limit(0), docs.limit(0)), str(tmp_path)) == 0


def test_dictionary_file(spark, tmp_path):
    rows = spark.createDataFrame([("10", None), ("9", "ê")], "candidate_id string, name string")
    one = W.write_jsonl_file(rows, str(tmp_path / "a.gz"), K.by_length())
    assert one == W.write_jsonl_file(rows.repartition(3), str(tmp_path / "b.gz"), K.by_length()) and one[0] == 2
    assert gzip.open(tmp_path / "a.gz", "rt", encoding="utf-8").read() == '{"candidate_id":"9","name":"ê"}\n{"candidate_id":"10","name":null}\n'
    assert [tuple(r) for r in K.counts_of(spark.sql("SELECT array('x', 'y') m UNION ALL SELECT array('x')"), "m").collect()] == [("x", 2), ("y", 1)]


def test_fingerprint_with_entities(spark):
    docs = spark.createDataFrame([("1", "ab"), ("2", "c")], "document_id string, raw_text string")
    entities = spark.createDataFrame([("1", 0, 1, "A"), ("1", 1, 2, "B")], SPAN)
    alone, both = P.fingerprint(docs).first()[0], P.fingerprint(docs, entities=entities).first()[0]
    assert alone != both == P.fingerprint(docs.repartition(3), entities=entities.orderBy(F.desc("start"))).first()[0]
    assert both != P.fingerprint(docs, entities=entities.limit(1)).first()[0] and alone == P.fingerprint(docs, entities=entities.limit(0)).first()[0]
