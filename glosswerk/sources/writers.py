"""Sinks: JSON documents, JSON lines, archives.

Results of any size are written by the executors.  The archive of a run's
output is one file for hand-over, so it is written by the driver, one document
after the other.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zipfile
from pathlib import Path

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def write_json(path: str, payload: object, sort_keys: bool = False) -> None:
    """One small JSON file on the driver: indented, without NaN, with newline ends."""
    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(json.dumps(payload, ensure_ascii=False, indent=2, allow_nan=False, sort_keys=sort_keys) + "\n", encoding="utf-8", newline="\n")


def read_json(path: str) -> object:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Gzipped JSON lines with their keys in order; ``order`` sorts the rows over all files."""
    rows = df.select(*sorted(df.columns))
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def jsonl_digest(df: DataFrame) -> str:
    """Digest of a table's rows as JSON, whatever their order."""
    line = F.sha2(F.to_json(F.struct(*sorted(df.columns))).cast("binary"), 256)
    parts = df.select(line.alias("d")).groupBy(F.substring("d", 1, 2).alias("g")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("d")), "").cast("binary"), 256).alias("d"))
    row = parts.agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("g", "d"))), lambda x: x["d"]), "").cast("binary"), 256)).first()
    return row[0]


def write_jsonl_file(df: DataFrame, path: str, order: list) -> tuple[int, str]:
    """One gzipped JSON-lines file, the same bytes for the same rows, and its (lines, SHA-256).

    Keys are sorted, rows are in ``order``, and the archive has no time.  The
    driver writes it, a partition at a time: for dictionaries, not for corpora.
    """
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    line, n = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 0
    with open(path, "wb") as raw, gzip.GzipFile(filename="", mode="wb", fileobj=raw, mtime=0) as out:
        for row in df.orderBy(*order).select(line.alias("line")).toLocalIterator():
            out.write(row["line"].encode() + b"\n")
            n += 1
    with open(path, "rb") as file:
        return n, hashlib.file_digest(file, "sha256").hexdigest()


def write_document_files(payloads: DataFrame, folder: str) -> int:
    """``<document_id>.json`` for each (document_id, payload), in place of the JSON files that were there; how many.

    Executors write the files, so ``folder`` is one they share: a path or an
    address that Arrow knows.  A task that runs again writes the same files.
    Ids that would leave the folder are an error.
    """
    fs, root = files.FileSystem.from_uri(folder if "://" in folder else Path(folder).absolute().as_uri())
    fs.create_dir(root)
    for info in fs.get_file_info(files.FileSelector(root)):
        if info.extension == "json":
            fs.delete_file(info.path)

    def run(batches):
        for batch in batches:
            for name, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name in ("", ".", "..") or "/" in name or "\\" in name:
                    raise ValueError(f"{name!r} can't be a file's name")
                body = json.dumps(json.loads(payload), ensure_ascii=False, indent=2) + "\n"
                with fs.open_output_stream(f"{root}/{name}.json") as out:
                    out.write(body.encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    rows = payloads.select(F.col("document_id").cast("string").alias("document_id"), "payload")
    return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def write_documents(payloads: DataFrame, path: str) -> None:
    """(document_id, payload) as text files in a folder for each document, replacing what was there."""
    payloads.select("document_id", F.col("payload").alias("value")).write.mode("overwrite").partitionBy("document_id").text(path)


def write_archive(payloads: DataFrame, path: str, folder: str = "output") -> list[str]:
    """ZIP of ``<folder>/<document_id>.json`` in natural order; the archive is read back and compared."""
    names = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for row in payloads.orderBy(*X.natural_key(F.col("document_id"))).select("document_id", "payload").toLocalIterator():
            names.append(f"{folder}/{row['document_id']}.json")
            archive.writestr(names[-1], json.dumps(json.loads(row["payload"]), ensure_ascii=False, indent=2) + "\n")
    with zipfile.ZipFile(path) as archive:
        if archive.namelist() != names or archive.testzip() is not None:
            raise ValueError(f"{path} isn't what was written")
    return names
