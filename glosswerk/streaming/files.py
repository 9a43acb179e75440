"""Extension: annotation of documents as they arrive.

Detection needs nothing but the document itself and the dictionary.  Windows
over a document aren't available on a stream, so each micro-batch, a table
like any other, goes through the batch operators, and is written under its
number: a batch that is repeated after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

DOCUMENT = "document_id string, raw_text string"


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Documents of JSON-lines files that arrive in a folder."""
    return spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", files_per_batch).json(path)


def annotate_stream(docs: DataFrame, annotate: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Runs ``annotate`` over each micro-batch and writes its rows to ``out/batch=<number>``."""

    def write(batch: DataFrame, number: int) -> None:
        annotate(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
