"""Exact deduplication by distributed MSD radix partitioning.

Documents are strings of bytes with their length in front.  A round splits
every open group by its next run of bytes (a radix digit of many bytes, so
that a few rounds reach the end of any text); groups of one row leave, groups
whose bytes have ended are classes of equal documents.  Bytes decide, no
digest does, neither in the groups nor in finding the rows again: a row carries
its group from round to round.

A group is named by a number that is given when the round's groups are
written, so it is unique whatever the ids are.  No round ships a group to one
place: counts and the smallest id come from a partial aggregation, and rows
find their group through a join whose large keys Spark can split.  The joins
are merge joins at any size, so that a run's cost is in proportion to its
input and nothing is broadcast that grows with it.

Defined results: a null text is the empty text; equal texts are equal after
each run of white space became one space.  Ids decide nothing but which row
stays: rows with one id and different texts are judged one by one.  A null id
loses against any other id; a class whose ids are all null has a null
``keep_id``, and its rows have ``kept`` true.  Repeated rows (same id and text)
count one by one in ``group_size`` and share ``kept``.  An empty table gives an
empty table.  Only the id and text columns are read, so other columns may have
any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, forget, hex_sha256, written

#: Bytes of the digit of the first round, and how much longer each next one is.
FIRST_DIGIT = 64
DIGIT_GROWTH = 64


def normalised(text: Column) -> Column:
    """Each run of white space as one space; runs that are one space already aren't touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[\x09-\x0D][{SPACE}]*| [{SPACE}]+", " ")


def radix_classes(rows: DataFrame, body: Column) -> DataFrame:
    """``rows`` (id, row, and perhaps body) with ``n``, the size of each row's class, and ``keep``, its smallest id.

    ``body`` says of a row the bytes that decide.  A column of that name is kept
    as long as its row is in an open group.
    """
    own = ["id", "row"] + [c for c in rows.columns if c == "body"]
    now = rows.select(*own, F.lit(0).cast("long").alias("grp"), F.octet_length(body).alias("len"))
    depth, width = 0, FIRST_DIGIT
    parts: list[DataFrame] = []
    while True:
        # a group is open while its bytes haven't ended; nothing is known of them before the first round
        still = now.where(F.col("len") > depth) if depth else now
        still = still.withColumn("digit", F.substring(body, depth + 1, width))
        key = ["grp", "len", "digit"]
        shared = still.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("keep")).where("n > 1")
        # the number is of the committed file's rows, so it is unique however often a task ran
        shared = written(shared.withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        depth += width
        met = still.join(shared.hint("merge"), key, "left")
        open_ = F.col("next").isNotNull() & (F.col("len") > depth)
        columns = ["id", "row", *(F.when(open_, F.col(c)).alias(c) for c in own[2:])]
        rows = written(met.select(*columns, "len", F.col("next").alias("grp"), "n", "keep"), "radix-rows")
        forget(shared)
        # rows that are alone or have ended leave here, the others come again in the next round's rows
        parts.append(rows.where((F.col("len") <= depth) | F.col("grp").isNull()))
        now = rows.where("grp IS NOT NULL").drop("n", "keep")
        width = min(width * DIGIT_GROWTH, 1 << 30)
        if now.where(F.col("len") > depth).isEmpty():
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    alone = F.col("grp").isNull()
    return out.select("id", "row", F.when(alone, 1).otherwise(F.col("n")).cast("long").alias("n"), F.when(alone, F.col("id")).otherwise(F.col("keep")).alias("keep"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 (of the normalised text, for output only)."""
    bodies = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).cast("binary").alias("body"))
    found = radix_classes(bodies.select("id", hex_sha256(F.col("body")).alias("row"), "body"), F.col("body"))
    return found.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"), F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("row").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a row with a smaller id has; all columns as they were."""
    rows = docs.select(F.col(id_col).alias("id"), F.struct(*(F.col(c) for c in docs.columns)).alias("row"))
    found = radix_classes(rows, normalised(F.col("row")[text_col]).cast("binary"))
    return found.where(F.col("id").eqNullSafe(F.col("keep"))).select(*(F.col("row")[c].alias(c) for c in docs.columns))
