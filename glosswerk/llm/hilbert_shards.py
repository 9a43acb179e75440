"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to a few bits; the curve index keeps rows that are
near in all dimensions near in the order, so that cutting the order into runs
gives files whose minima and maxima prune on every dimension.  The cuts follow
the law ``rows``: shard sizes differ by one row at most.

Order: curve index, id, size, crc32 of the text.  It is total up to rows that
are equal in all of these, which are interchangeable.

Defined results: a null text has size 8 and the crc32 of no bytes; nulls in a
dimension take its cell 0; null ids come first among equal curve indexes; more
shards than rows leave shards empty; an empty table gives an empty table.
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Bits of each dimension's cell number.
BITS = 6
#: Rows of a partition have their number below this power of two.
ROW_BITS = 33


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of points (rows of ``cells``, uint64), by the transposed-axes transform."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        p = q - one
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        t ^= np.where((x[dims - 1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out


def _with_curve(dims: list[str], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            cells = np.stack([batch.column(names.index(d)).to_numpy(zero_copy_only=False).astype(np.uint64) for d in dims], axis=1)
            curve = pa.array(hilbert_index(cells, bits).astype(np.int64))
            kept = [n for n in names if n not in dims]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(n)) for n in kept), curve], names=[*kept, "curve"])

    return run


def _cell(docs: DataFrame, name: str, bits: int):
    """Strings by the hash of the value, so equality prunes; numbers by their magnitude, so ranges prune."""
    if dict(docs.dtypes)[name] == "string":
        cell = F.pmod(F.crc32(F.col(name).cast("binary")), F.lit(1 << bits))
    else:
        cell = F.least(F.floor(F.log2(F.greatest(F.abs(F.col(name).cast("double")), F.lit(1.0))) * 2), F.lit((1 << bits) - 1))
    return F.coalesce(cell, F.lit(0)).cast("long")


def hilbert_shards(docs: DataFrame, shards: int = 24, dims: tuple[str, ...] = ("lang", "source"), id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, curve, shard, slot.

    The size of a row, its magnitude, is a dimension besides ``dims``.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    meta = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *(_cell(docs, d, bits).alias(f"d{i}") for i, d in enumerate(dims)),
    )
    names = [f"d{i}" for i in range(len(dims) + 1)]
    meta = meta.withColumn(names[-1], _cell(meta, "size", bits))
    curved = meta.mapInArrow(_with_curve(names, bits), "id long, size long, text_crc32 long, curve long")
    order = ["curve", "id", "size", "text_crc32"]
    # the checkpoint fixes which row has which place: later passes read the same partitions in the same order
    ranged = checkpointed(curved.repartitionByRange(*order).sortWithinPartitions(*order))
    place = F.monotonically_increasing_id()
    placed = ranged.withColumn("at", place).withColumn("part", F.shiftright("at", ROW_BITS)).withColumn("pos", F.col("at").bitwiseAND((1 << ROW_BITS) - 1))
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each partition
    before, total = [], 0
    for part in sorted(counts):
        before.append((part, total))
        total += counts[part]
    spark = docs.sparkSession
    starts = spark.createDataFrame(before or [(-1, 0)], "part long, before long")
    least, longer = divmod(total, shards)
    # the first `longer` shards have one row more than the others
    cut = longer * (least + 1)
    ranked = placed.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("pos"))
    small = F.lit(max(least, 1))
    shard = F.when(F.col("rank") < cut, F.floor(F.col("rank") / F.lit(least + 1))).otherwise(longer + F.floor((F.col("rank") - cut) / small))
    start = F.when(F.col("rank") < cut, F.col("shard") * (least + 1)).otherwise(cut + (F.col("shard") - longer) * least)
    return ranked.withColumn("shard", shard.cast("int")).select(F.col("id").alias(id_col), "size", "text_crc32", "curve", "shard", (F.col("rank") - start).cast("long").alias("slot"))
