"""Scans: text and annotation folders, archives, dictionaries, concept files, workbooks.

Paths go to Spark's readers, so any store that Spark reads will do.  Archives
and workbooks have no reader in Spark: their bytes come from ``binaryFile`` and
are taken apart on the executors.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.profile import require_unique_ids

DOCUMENT = "document_id string, raw_text string"
ENTITY = "array<struct<text:string,type:string,position:array<int>,candidates:array<string>,assertions:array<string>>>"


def stem(path: Column) -> Column:
    """A file's name without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(?<=.)\.[^.]*$", "")


def _whole(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(document_id, raw_text) of the files of a folder; bytes that aren't UTF-8 are an error."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return rows.select(stem(F.col("path")).alias("document_id"), F.validate_utf8(F.col("content").cast("string")).alias("raw_text"))


def read_text_folder(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the ``*.txt`` files of a folder; line ends become newlines, ids are file names and must differ."""
    rows = _whole(spark, path, "*.txt")
    return require_unique_ids(rows.withColumn("raw_text", F.regexp_replace("raw_text", r"\r\n?", "\n")))


def safe_member(name: str) -> bool:
    """Whether an archive's member stays below the folder it is unpacked into."""
    path = PurePosixPath(name.replace("\\", "/"))
    return not path.is_absolute() and ".." not in path.parts and not re.match(r"^[A-Za-z]:", name)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for name in archive.namelist():
                    if not safe_member(name):
                        raise ValueError(f"unsafe archive member: {name}")
                    if not name.endswith("/"):
                        yield pd.DataFrame({"name": [name], "content": [archive.read(name)]})


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of the members of ZIP archives."""
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(_members, "name string, content binary")


def read_text_archive(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the ``.txt`` members of a ZIP archive, at any depth, with their line ends as they are."""
    rows = read_archive(spark, path).where(F.lower("name").endswith(".txt"))
    return require_unique_ids(rows.select(stem(F.col("name")).alias("document_id"), F.validate_utf8(F.col("content").cast("string")).alias("raw_text")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of an archive (``.zip``) or of a folder."""
    return read_text_archive(spark, path) if path.lower().endswith(".zip") else read_text_folder(spark, path)


def payload_entities(payload: Column) -> Column:
    """Entities of an annotation: a list, or an object with the list in ``entities``; anything else is an error."""
    v = F.try_parse_json(payload)
    kind = F.schema_of_variant(v)
    inner = F.get_json_object(payload, "$.entities")
    listed = F.when(F.startswith(kind, F.lit("ARRAY")), payload).when(F.startswith(kind, F.lit("OBJECT")) & inner.isNotNull(), inner)
    return F.when(listed.isNull(), F.raise_error(F.lit("annotation must be a list"))).otherwise(F.from_json(listed, ENTITY))


def _parsed(rows: DataFrame) -> DataFrame:
    """Annotated documents with checked offsets and internal types.

    An entity without text, type or a place of two numbers, or whose text isn't at its place, is an error.
    """

    def one(e: Column) -> Column:
        start, end = F.try_element_at(e["position"], F.lit(1)), F.try_element_at(e["position"], F.lit(2))
        good = e["type"].isNotNull() & (F.size(e["position"]) == 2) & X.offsets_valid(F.col("raw_text"), start, end, e["text"])
        empty = F.array().cast("array<string>")
        made = F.struct(start.alias("start"), end.alias("end"), e["text"].alias("text"), X.internal_type(e["type"]).alias("type"), F.coalesce(e["candidates"], empty).alias("candidates"), F.coalesce(e["assertions"], empty).alias("assertions"))
        return F.when(F.coalesce(good, F.lit(False)), made).otherwise(F.raise_error(F.concat(F.lit("bad entity in "), F.col("document_id"))))

    return rows.withColumn("entities", F.transform("entities", one))


def read_annotated(spark: SparkSession, path: str, layout: str = "paired") -> DataFrame:
    """(document_id, raw_text, entities) of texts with annotations.

    ``paired`` is input/*.txt beside gt/*.json, ``sibling`` *.txt beside *.json
    in one folder; texts without annotation are left out.  ``self`` is *.json
    without a *.txt beside it: objects, or lists of objects, with ``raw_text``.
    """
    if layout == "self":
        files = _whole(spark, path, "*.json").withColumnRenamed("raw_text", "payload")
        texts = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select(stem(F.col("path")).alias("document_id"))
        alone = files.join(texts, "document_id", "left_anti")
        v = F.try_parse_json("payload")
        listed = F.when(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), F.col("payload")).otherwise(F.concat(F.lit("["), F.col("payload"), F.lit("]")))
        record = "array<struct<raw_text:string,document_id:string,entities:" + ENTITY + ">>"
        rows = alone.select(F.col("document_id").alias("file"), F.posexplode(F.from_json(listed, record)).alias("i", "r")).where("r.raw_text IS NOT NULL")
        name = F.coalesce("r.document_id", F.concat_ws("_", "file", "i"))
        return _parsed(rows.select(name.alias("document_id"), F.col("r.raw_text").alias("raw_text"), F.coalesce("r.entities", F.from_json(F.lit("[]"), ENTITY)).alias("entities")))
    texts, notes = (f"{path}/input", f"{path}/gt") if layout == "paired" else (path, path)
    body = _whole(spark, texts, "*.txt").withColumn("raw_text", F.regexp_replace("raw_text", r"\r\n?", "\n"))
    found = _whole(spark, notes, "*.json").select("document_id", payload_entities(F.col("raw_text")).alias("entities"))
    return _parsed(body.join(found, "document_id"))


def entities_of(annotated: DataFrame) -> DataFrame:
    """One row for each entity of annotated documents, with its place in the list as ``ord``."""
    return annotated.select("document_id", F.posexplode("entities").alias("ord", "e")).select("document_id", "ord", "e.*")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines, gzipped or not; blank lines are skipped, a bad line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


RECORD = "candidate_id string, canonical_name string, name_vi string, name_en string, aliases array<string>, detection_aliases array<string>, source string"


def read_records(spark: SparkSession, path: str, vocabulary: str) -> DataFrame:
    """Records of a dictionary, as the linking operators take them."""
    rows = read_jsonl(spark, path, RECORD)
    empty = F.array().cast("array<string>")
    name = F.coalesce("canonical_name", F.when(F.col("name_vi") != "", F.col("name_vi")), "name_en")
    return rows.withColumns({"canonical_name": name, "aliases": F.coalesce("aliases", empty), "detection_aliases": F.coalesce("detection_aliases", empty), "vocabulary": F.lit(vocabulary)})


CONCEPT = "RXCUI LAT TS LUI STT SUI ISPREF RXAUI SAUI SCUI SDUI SAB TTY CODE STR SRL SUPPRESS CVF".split()
RELATION = "RXCUI1 RXAUI1 STYPE1 REL RXCUI2 RXAUI2 STYPE2 RELA RUI SRUI SAB SL RG DIR SUPPRESS CVF".split()


def rich_rows(lines: DataFrame, fields: list[str], line: str = "value") -> DataFrame:
    """Lines of fields with a bar after each as columns; another number of fields is an error."""
    parts = F.split(F.regexp_replace(line, r"\r$", ""), r"\|", -1)
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1)))).otherwise(parts)
    checked = F.when(F.size(parts) == len(fields), parts).otherwise(F.raise_error(F.concat(F.lit(f"expected {len(fields)} fields: "), F.col(line))))
    keep = [c for c in lines.columns if c != line]
    return lines.withColumn("f_", checked).select(*keep, *(F.col("f_")[i].alias(n) for i, n in enumerate(fields)))


def read_rich(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Rows of an unpacked concept or relation file, with ``ord`` in the order of the file."""
    return rich_rows(spark.read.text(path).withColumn("ord", F.monotonically_increasing_id()), fields)


def read_rich_member(spark: SparkSession, path: str, member: str, fields: list[str]) -> DataFrame:
    """Rows of one member of a ZIP archive; the member is read as a stream, line by line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    if member not in archive.namelist():
                        raise ValueError(f"missing member: {member}")
                    with io.TextIOWrapper(archive.open(member), encoding="utf-8", errors="strict", newline="\n") as stream:
                        block: list[str] = []
                        at = 0
                        for text in stream:
                            block.append(text.rstrip("\n"))
                            if len(block) == 50_000:
                                yield pd.DataFrame({"ord": range(at, at + len(block)), "value": block})
                                at, block = at + len(block), []
                        yield pd.DataFrame({"ord": range(at, at + len(block)), "value": block})

    lines = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "ord long, value string")
    return rich_rows(lines, fields)


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_rows(content: bytes, sheet: str) -> Iterator[list[str]]:
    """Cells of a workbook's sheet as texts, row by row; missing rows and cells are empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = {s.get("name"): s.get(_REL) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}
        if sheet not in names:
            raise ValueError(f"missing sheet: {sheet}")
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        target = targets[names[sheet]].lstrip("/")
        at = 0
        with book.open(target if target.startswith("xl/") else f"xl/{target}") as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r") or at + 1)
                while at + 1 < number:
                    at += 1
                    yield []
                at = number
                cells: list[str] = []
                for k, c in enumerate(row.iter(f"{_MAIN}c")):
                    letters = re.match("[A-Z]*", c.get("r") or "").group()
                    place = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters))) - 1 if letters else k
                    cells += [""] * (place + 1 - len(cells))
                    value = c.find(f"{_MAIN}v")
                    if c.get("t") == "inlineStr":
                        cells[place] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif value is not None:
                        cells[place] = shared[int(value.text)] if c.get("t") == "s" else value.text or ""
                yield cells
                row.clear()


def read_sheet(spark: SparkSession, path: str, sheet: str = "ICD10", header_row: int = 3, columns: dict[str, str] | None = None) -> DataFrame:
    """(ord, columns) of a workbook's sheet below its header row.

    ``columns`` has the names of the result by the headings; a heading that the
    sheet doesn't have is an error, and rows without any value are left out.
    """
    columns = columns or {"MÃ BỆNH": "display_code", "MÃ BỆNH KHÔNG DẤU": "code_without_dot", "DISEASE NAME": "name_en", "TÊN BỆNH": "name_vi"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                place, out = None, []
                for n, cells in enumerate(sheet_rows(content, sheet), 1):
                    if n == header_row:
                        heads = [re.sub(r"\s+", " ", c.strip()).upper() for c in cells]
                        if missing := [h for h in columns if h not in heads]:
                            raise ValueError(f"missing headings: {missing}")
                        place = [heads.index(h) for h in columns]
                    elif place is not None:
                        row = [cells[i].strip() if i < len(cells) else "" for i in place]
                        if any(row):
                            out.append([n, *row])
                yield pd.DataFrame(out, columns=["ord", *columns.values()])

    schema = ", ".join(["ord long", *(f"{c} string" for c in columns.values())])
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def inventory(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, size, sha256) of files."""
    rows = spark.read.format("binaryFile").load(paths)
    return rows.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
