"""Detection, linking, output and quality on small notes, with values worked out by hand."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from glosswerk.functions import lexicons as L
from glosswerk.operators import detect as D
from glosswerk.operators import knowledge as K
from glosswerk.operators import metrics as M
from glosswerk.operators import models as N
from glosswerk.operators import profile as P
from glosswerk.operators import retrieval as R
from glosswerk.operators import spans as G
from glosswerk.operators import submission as O
from glosswerk.plans import annotation as A
from glosswerk.sources import readers as I
from glosswerk.sources import writers as W
from glosswerk.streaming import files as S

TEXT = "Tiền sử: tăng huyết áp.\nBệnh nhân không sốt, dùng aspirin 81 mg po daily trị đau ngực.\nglucose: 7,5 mmol/L"
KB = [
    ("ICD10", "DISEASE", "I10", "tăng huyết áp", ["tăng huyết áp", "I10"], ["tăng huyết áp", "ho", "1234", "abcd", "abcde"], 0),
    ("ICD10", "DISEASE", "R07", "đau ngực", ["đau ngực"], ["đau ngực"], 1),
    ("RXNORM", "DRUG", "1191", "aspirin", ["aspirin", "acid acetylsalicylic"], ["aspirin"], 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("1", TEXT), ("2", "")], "document_id string, raw_text string").cache()


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(KB, "vocabulary string, type string, candidate_id string, canonical_name string, aliases array<string>, detection_aliases array<string>, ord int").cache()


@pytest.fixture(scope="module")
def annotated(docs, records):
    return A.annotated(docs, records).cache()


def test_phrases(records):
    assert {r["phrase"] for r in D.phrases(records).collect()} == {"tăng huyết áp", "abcde", "đau ngực", "aspirin"}


def test_chain(annotated):
    rows = {r["text"]: r for r in annotated.collect()}
    assert set(rows) == {"tăng huyết áp", "sốt", "aspirin 81 mg po daily", "đau ngực", "glucose: 7,5 mmol/L"}
    assert all(TEXT[r["start"] : r["end"]] == t for t, r in rows.items())
    assert rows["đau ngực"]["type"] == "SYMPTOM"  # the rule wins over the dictionary's disease
    assert rows["aspirin 81 mg po daily"]["mention_head"] == "aspirin"
    assert rows["glucose: 7,5 mmol/L"]["mention_head"] == "glucose"
    assert rows["sốt"]["polarity"] == "NEGATED"
    assert rows["tăng huyết áp"]["temporality"] == "HISTORICAL" and rows["tăng huyết áp"]["section_name"] == "HISTORY"
    assert rows["tăng huyết áp"]["candidates"][0] == "I10"
    assert rows["aspirin 81 mg po daily"]["candidates"][0] == "1191"


def test_linked_by_detection_alone(docs, records):
    s = A.Settings(keep_detected=True, output_k=1)
    rows = A.linked(A.entities(docs, records, s), records, s).where("type IN ('DISEASE', 'DRUG')").collect()
    assert {(r["candidate_id"], tuple(r["candidates"])) for r in rows} == {("I10", ("I10",)), ("1191", ("1191",))}


def test_relations(docs, annotated):
    rows = D.relations(annotated, G.sentences(docs), L.RELATIONS).collect()
    assert {(r["subject_type"], r["object_type"], r["relation"]) for r in rows} == {("DRUG", "SYMPTOM", "DRUG_TREATS_CONDITION")}
    near = [r for r in rows if TEXT[r["object_start"] : r["object_end"]] == "đau ngực"][0]
    assert near["confidence"] == pytest.approx(0.88 - near["distance"] / 256 * 0.25, abs=1e-6)


def test_relation_bounds(spark):
    text = "x" * 300
    sent = spark.createDataFrame([("0", 0, 0, 300)], "document_id string, sentence_id int, start int, end int")
    rows = spark.createDataFrame([("0", 0, 5, "DRUG"), ("0", 5, 8, "SYMPTOM"), ("0", 261, 270, "DISEASE"), ("0", 262, 270, "DISEASE")], "document_id string, start int, end int, type string")
    got = {(r["object_start"], r["confidence"]) for r in D.relations(rows, sent, L.RELATIONS).where("subject_type = 'DRUG'").collect()}
    assert got == {(5, 0.88), (261, 0.63)} and len(text) == 300


def test_submission_is_valid(docs, annotated):
    out = O.submission(annotated)
    files = O.as_documents(out, docs)
    payload = {r["document_id"]: json.loads(r["payload"]) for r in files.collect()}
    assert payload["2"] == []
    assert [set(e) for e in payload["1"] if e["type"] == "KẾT_QUẢ_XÉT_NGHIỆM"] == [{"text", "type", "position"}]
    assert O.validate(files, docs).isEmpty()
    assert O.complete(files, docs).isEmpty()


def test_validation_errors(spark, docs):
    bad = [
        {"text": "Tiền", "type": "TRIỆU_CHỨNG", "position": [0, 4], "assertions": ["isNegated"]},
        {"text": "Tiền", "type": "TRIỆU_CHỨNG", "position": [1, 5], "assertions": []},
        {"text": "Tiền", "type": "X", "position": [0, 4]},
        {"text": "Tiền", "type": "THUỐC", "position": [0, 4], "assertions": []},
        {"text": "Tiền", "type": "TRIỆU_CHỨNG", "position": [0], "assertions": "no"},
        {"text": "Tiền", "type": "TRIỆU_CHỨNG", "position": [0, 4], "assertions": ["isSick"]},
        3,
    ]
    rows = spark.createDataFrame([("1", json.dumps(bad)), ("2", "{}")], "document_id string, payload string")
    got = {(r["document_id"], r["i"], r["error"]) for r in O.validate(rows, docs).collect()}
    assert got == {
        ("1", 1, "offset mismatch"), ("1", 2, "unsupported type"), ("1", 3, "invalid keys"), ("1", 3, "candidates must be a list"), ("1", 4, "invalid position"),
        ("1", 4, "assertions must be a list"), ("1", 5, "unsupported assertions"), ("1", 6, "not an object"), ("2", None, "not an array"),
    }


def test_summary_and_dropped(docs, annotated):
    row = O.summary(annotated, docs, D.relations(annotated, G.sentences(docs), L.RELATIONS)).first()
    assert (row["documents"], row["entities"], row["unmapped"], row["offset_errors"]) == (2, 5, 0, 0)
    assert O.dropped(annotated.withColumn("type", F.lit("PATIENT_INFO"))).first()["n"] == 5
    official = annotated.withColumn("type", F.lit("THUỐC"))
    assert {r["type"] for r in O.relabel(official).collect()} == {"DRUG"}


def test_rrf(spark):
    one = spark.createDataFrame([("q", "I10", 1)], "query string, candidate_id string, rank int")
    assert R.rrf(one, one, 5).first()["score"] == 0.016393
    none = one.limit(0)
    assert R.rrf(none, one, 5).first()["candidate_id"] == "I10"  # no lexical hit: the semantic one counts
    assert R.rrf(none, none, 5).isEmpty()


def test_lexical(spark):
    corpus = spark.createDataFrame([("A", 0, "tăng huyết áp"), ("B", 0, "huyết áp thấp"), ("C", 0, "sốt rét")], "candidate_id string, place int, norm string")
    asked = spark.createDataFrame([("q1", "tăng huyết áp"), ("q2", "sốt r"), ("q3", "sốzz"), ("q4", "")], "query string, norm string")
    got = R.lexical(corpus, asked).collect()
    assert [(r["candidate_id"], r["method"]) for r in sorted(got, key=lambda r: (r["query"], r["rank"])) if r["query"] == "q1"] == [("A", "exact"), ("B", "lexical")]
    assert {r["query"] for r in got} == {"q1", "q2"}


def test_knowledge(spark):
    sheet = spark.createDataFrame([(4, "A01.0†", "A010", "Typhoid", "Thương hàn"), (5, "A01.0", "A010", "", "Thương hàn"), (6, "A01.0*", "", "Typhoid fever", ""), (7, "", "", "", "")], "ord long, display_code string, code_without_dot string, name_en string, name_vi string")
    row = K.icd_records(sheet).first()
    assert row["candidate_id"] == "A01.0" and row["aliases"] == ["A01.0", "A010", "Typhoid", "Thương hàn", "Typhoid fever"]
    assert row["display_codes"] == ["A01.0†", "A01.0", "A01.0*"] and row["markers"] == ["†", "*"] and row["name_en"] == "Typhoid"
    with pytest.raises(Exception, match="code mismatch"):
        K.icd_records(sheet.withColumn("code_without_dot", F.lit("B99"))).collect()
    records = K.icd_records(sheet)
    assert K.verify_records(records, 1) == {"record_count": 1, "unique_ids": 1}
    for wrong, message in ((records.union(records), "that another has"), (records.withColumn("candidate_id", F.lit("")), "without candidate_id")):
        with pytest.raises(ValueError, match=message):
            K.verify_records(wrong)
    with pytest.raises(ValueError, match="expected 2"):
        K.verify_records(records, 2)
    gold = spark.createDataFrame([("A01.0", "sốt thương hàn", 1), ("A01.0", "Typhoid", 2), ("zz", "x", 3)], "candidate_id string, text string, ord int")
    more = K.enrich(records, gold).first()
    assert more["n_added"] == 1 and more["aliases"][-1] == "sốt thương hàn"


def bag(spark, *rows):
    return spark.createDataFrame([("d", s, e, k, t, c, a, i, conf) for i, (s, e, k, t, c, a, conf) in enumerate(rows)], "document_id string, start int, end int, type string, text string, candidates array<string>, assertions array<string>, ord int, confidence double")


def test_metrics(spark):
    gold = bag(spark, (0, 3, "A", "a b", ["1"], [], 1.0), (0, 3, "A", "a b", ["1"], [], 1.0), (5, 9, "B", "c d", [], ["isNegated"], 1.0))
    predicted = bag(spark, (0, 3, "A", "a b", ["1", "2"], [], 0.9), (6, 9, "B", "c", [], ["isNegated"], 0.8), (20, 22, "B", "z", [], [], 0.7))
    row = M.exact_metrics(gold, predicted).first()
    assert (row["true_positive"], row["false_positive"], row["false_negative"]) == (1, 2, 2) and row["precision"] == 0.333333
    row = M.relaxed_metrics(gold, predicted).first()
    assert (row["true_positive"], row["false_positive"], row["false_negative"]) == (2, 1, 1)
    row = M.competition_score(gold, predicted).first()
    assert (row["matched_entities"], row["text_score"], row["candidates_score"]) == (1, 0.333333, 0.166667)
    row = M.competition_score(gold, predicted, approximate=True).first()
    assert (row["matched_entities"], row["text_score"], row["assertions_score"]) == (2, 0.5, 0.666667)
    empty = M.exact_metrics(gold.limit(0), predicted.limit(0)).first()
    assert (empty["precision"], empty["recall"], empty["f1"]) == (0.0, 0.0, 0.0)
    assert {(r["error"]) for r in M.errors(gold, predicted).collect()} == {"wrong bounds", "spurious"}


def test_token_metrics(spark):
    rows = spark.createDataFrame([(0, 0), (1, 1), (-100, 2), (1, 0)], "label int, predicted int").union(spark.createDataFrame([(0, 1)], "label int, predicted int").limit(0))
    row = M.token_metrics(rows.union(spark.createDataFrame([(2, 2), (0, 1)], "label int, predicted int").limit(0))).first()
    assert (row["precision"], row["recall"], row["accuracy"]) == (1.0, 0.5, 0.666667)


def test_profile(spark, docs):
    row = P.describe(docs).first()
    assert (row["documents"], row["min_characters"], row["max_lines"]) == (2, 0, 3)
    assert P.describe(docs.limit(0)).first()["mean_lines"] is None
    with pytest.raises(ValueError, match="duplicate"):
        P.require_unique_ids(docs.union(docs))
    assert P.fingerprint(docs).first()[0] == P.fingerprint(docs.repartition(3)).first()[0] != P.fingerprint(docs.limit(1)).first()[0]
    train, validation = P.exact_split([str(i) for i in range(5)])
    assert len(validation) == 1 and sorted(train + validation) == list("01234") and P.exact_split(["a"]) == (["a"], [])
    assert P.same_rows(docs, docs.repartition(2)) and not P.same_rows(docs, docs.limit(1))


def test_models(spark, docs, records, annotated):
    def tagger():
        return lambda texts: [[(9, 13, "B-DISEASE", 0.9), (14, 19, "I-DISEASE", 0.7)] if t else [] for t in texts]

    row = N.model_entities(docs, tagger).first()
    assert (row["text"], row["type"], row["confidence"]) == ("tăng huyết", "DISEASE", pytest.approx(0.8))
    chosen = N.rerank(annotated, docs, lambda: lambda prompts: ['{"selected_id": null}' if "Mention: aspirin" in p else "?" for p in prompts], records)
    rows = {r["text"]: r for r in chosen.collect()}
    assert rows["aspirin 81 mg po daily"]["warning"] is None and rows["aspirin 81 mg po daily"]["candidates"] == ["1191"]
    assert rows["tăng huyết áp"]["warning"] == "not a JSON object" and len(rows) == 5
    axes = N.model_axes(annotated, docs, lambda: lambda prompts: ['{"polarity": "NEGATED"}'] * len(prompts)).collect()
    assert {(r["polarity"], r["certainty"]) for r in axes} == {("NEGATED", "CONFIRMED")}
    with pytest.raises(ValueError):
        list(N.batches_of([1], 0))


def test_folders_and_archives(spark, tmp_path):
    (tmp_path / "input").mkdir(), (tmp_path / "gt").mkdir()
    text = "Đau ngực, xét nghiệm glucose."
    (tmp_path / "input" / "1.txt").write_bytes(text.encode() + b"\r\nx")
    (tmp_path / "input" / "2.txt").write_text("alone")
    note = [{"text": "Đau ngực", "type": "TRIỆU_CHỨNG", "position": [0, 8]}, {"text": "xét nghiệm", "type": "TÊN_XÉT_NGHIỆM", "position": [10, 20]}]
    (tmp_path / "gt" / "1.json").write_text(json.dumps(note))
    rows = I.entities_of(I.read_annotated(spark, str(tmp_path))).orderBy("ord").collect()
    assert [(r["type"], r["start"], r["end"]) for r in rows] == [("SYMPTOM", 0, 8), ("LAB_NAME", 10, 20)]
    assert {r["document_id"]: r["raw_text"] for r in I.read_documents(spark, str(tmp_path / "input")).collect()} == {"1": text + "\nx", "2": "alone"}
    (tmp_path / "gt" / "1.json").write_text(json.dumps({"entities": [note[0] | {"position": [1, 9]}]}))
    with pytest.raises(Exception, match="bad entity"):
        I.read_annotated(spark, str(tmp_path)).collect()
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "a.json").write_text(json.dumps([{"raw_text": "x", "entities": [{"text": "x", "type": "THUỐC", "position": [0, 1]}]}, {"other": 1}, {"raw_text": "y", "document_id": "n"}]))
    assert {(r["document_id"], len(r["entities"])) for r in I.read_annotated(spark, str(tmp_path / "own"), "self").collect()} == {("a_0", 1), ("n", 0)}
    with zipfile.ZipFile(tmp_path / "docs.zip", "w") as z:
        z.writestr("deep/3.txt", "a\r\nb")
        z.writestr("deep/notes.md", "no")
    assert [tuple(r) for r in I.read_documents(spark, str(tmp_path / "docs.zip")).collect()] == [("3", "a\r\nb")]
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../3.txt", "a")
    with pytest.raises(Exception, match="unsafe"):
        I.read_text_archive(spark, str(tmp_path / "bad.zip")).collect()
    assert not I.safe_member("/etc/x") and not I.safe_member("a/../../b") and I.safe_member("a/b.txt")


def test_concept_files(spark, tmp_path):
    line = lambda cui, name, tty: "|".join([cui, "ENG", *[""] * 9, "RXNORM", tty, "", name, "", "N", ""]) + "|"
    with zipfile.ZipFile(tmp_path / "rx.zip", "w") as z:
        z.writestr("rrf/RXNCONSO.RRF", "\n".join([line("1", "aspirin", "IN"), line("1", "Bayer", "BN"), line("2", "x", "ZZ")]) + "\n")
    rows = I.read_rich_member(spark, str(tmp_path / "rx.zip"), "rrf/RXNCONSO.RRF", I.CONCEPT)
    record = K.concept_records(K.concept_rows(rows, ["ENG"], ["RXNORM"], ["IN", "BN"], ["N"])).first()
    assert (record["canonical_name"], record["aliases"], record["brand_names"]) == ("aspirin", ["aspirin", "Bayer"], ["Bayer"])
    with pytest.raises(Exception, match="expected 18 fields"):
        I.rich_rows(spark.createDataFrame([("a|b|",)], "value string"), I.CONCEPT).collect()


def test_sheet(spark, tmp_path):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    cell = lambda ref, text: f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'
    heads = ["MÃ  BỆNH", "MÃ BỆNH KHÔNG DẤU", "Disease name", "TÊN BỆNH"]
    rows = [f'<row r="3">{"".join(cell(f"{c}3", h) for c, h in zip("ABCD", heads))}</row>', f'<row r="5">{cell("A5", "A01.0†")}{cell("D5", " Thương hàn ")}</row>', '<row r="6"></row>']
    with zipfile.ZipFile(tmp_path / "icd.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="ICD10" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(rows)}</sheetData></worksheet>')
    got = I.read_sheet(spark, str(tmp_path / "icd.xlsx")).collect()
    assert [tuple(r) for r in got] == [(5, "A01.0†", "", "", "Thương hàn")]
    with pytest.raises(Exception, match="missing sheet"):
        I.read_sheet(spark, str(tmp_path / "icd.xlsx"), "X").collect()


def test_json_lines_and_archive(spark, tmp_path, docs):
    with gzip.open(tmp_path / "kb.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write('{"candidate_id": "I10", "aliases": ["tăng huyết áp"]}\n\n')
    row = I.read_records(spark, str(tmp_path / "kb.jsonl.gz"), "ICD10").first()
    assert (row["candidate_id"], row["aliases"], row["detection_aliases"]) == ("I10", ["tăng huyết áp"], [])
    W.write_jsonl(docs, str(tmp_path / "out"), ["document_id"])
    assert W.jsonl_digest(spark.read.json(str(tmp_path / "out"))) == W.jsonl_digest(docs.repartition(2))
    payloads = spark.createDataFrame([("10", "[]"), ("9", '[{"a": 1}]')], "document_id string, payload string")
    assert W.write_archive(payloads, str(tmp_path / "o.zip")) == ["output/9.json", "output/10.json"]
    W.write_documents(payloads, str(tmp_path / "files"))
    assert spark.read.text(str(tmp_path / "files")).count() == 2
    W.write_json(str(tmp_path / "x" / "a.json"), {"b": 1, "a": "é"}, sort_keys=True)
    assert W.read_json(str(tmp_path / "x" / "a.json")) == {"a": "é", "b": 1}
    assert I.inventory(spark, [str(tmp_path / "o.zip")]).first()["size"] == (tmp_path / "o.zip").stat().st_size


def test_settings_merge():
    assert A.merged({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 5}, "e": 6}) == {"a": {"b": 5, "c": 2}, "d": 3, "e": 6}


def test_stream(spark, tmp_path, docs, records):
    docs.write.json(str(tmp_path / "in"))
    stream = S.read_stream(spark, str(tmp_path / "in"))
    q = S.annotate_stream(stream, lambda batch: A.entities(batch, records), str(tmp_path / "out"), str(tmp_path / "ck"), once=True)
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
