"""Near-duplicate groups by min-max hashing.

A text's set is its distinct shingles of words.  Under each permutation both
the minimum and the maximum of the set are kept, so a signature has two values
for each hash evaluation; both agree between two sets with a probability equal
to their similarity.  Values are banded; texts that share a band's bucket are
candidates, and a link counts only after the full sets confirm it.

1. Rows with equal sets (two 64-bit digests and the size) become one node, so
   copies never meet each other.  Nodes are numbered when they are written.
2. Each bucket has two hubs, one by a hash of the text and one by a hash of the
   text and the band; every other member is compared with both: two comparisons a
   row.  Links give components.
3. A bucket whose members are still in several components is finished
   exactly: all members outside its largest component (the strays) are
   compared with all members of other components, in blocks of bounded size.
   Each pair is compared in the first bucket that it shares.

So every pair that shares a bucket is confirmed, refused or in one component
by then, without a task that holds a whole bucket.  The joins are merge joins at
any size, whose large keys Spark can split.  A pair at the threshold
shares no bucket with a probability below ``MISS``.

Defined results: A-Z are lower-cased.  A text with fewer words than a shingle
has its whole sequence as one shingle; one without words, or a null text, has
an empty set and no links.  A row with a null id has no links, a null
``component_id``, and is kept.  Rows with one id but different texts belong to
the groups of each of them, and ``drop_near_duplicates`` judges each row by its
own text: of a group those rows stay that have its smallest id and, of the sets
with that id, the same one.  Repeated rows (same id and set) share a result, so
all of them stay or go.  An empty table gives an empty table.  Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, given_back, slices, string_buffers, written
from .components import connected_components
from .textscan import LOWER, mix, shingles, words

#: Chance that a pair at the threshold shares no bucket, and values of a signature in each band.
MISS, BAND_VALUES = 1e-5, 4
BATCH_BYTES = 2 << 20
#: Strays and members of a block of step 3, and shingles that either are expected to have (or those of one text).
STRAYS, MEMBERS, BLOCK_SHINGLES = 256, 512, 1 << 20
_U = np.uint64


def bands_for(percent: int) -> int:
    """Bands needed for a threshold: an even number, so that each permutation serves one minimum and one maximum."""
    b = math.log(MISS) / math.log(1 - (percent / 100) ** BAND_VALUES)
    return 2 * math.ceil(b / 2)


def _family(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and masks of the permutations: half as many as there are values."""
    n = bands * BAND_VALUES // 2
    seeds = mix(np.arange(1, 2 * n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    return seeds[:n] | _U(1), seeds[n:]


def signatures(sets: np.ndarray, bounds: np.ndarray, bands: int) -> np.ndarray:
    """(texts, 2 * permutations): minima, then maxima; zeros for empty sets."""
    multipliers, masks = _family(bands)
    n = len(multipliers)
    out = np.zeros((len(bounds) - 1, 2 * n), _U)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        starts = bounds[full]
        for k in range(n):
            x = (sets ^ masks[k]) * multipliers[k]
            out[full, k] = np.minimum.reduceat(x, starts)
            out[full, n + k] = np.maximum.reduceat(x, starts)
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """(texts, bands): two minima and two maxima of other permutations, and the band's number, as one hash."""
    n = sig.shape[1] // 2
    keys = np.empty((len(sig), bands), _U)
    for j in range(bands):
        h = np.full(len(sig), j + 1, _U)
        for v in (2 * j % n, (2 * j + 1) % n, n + (2 * j + 2) % n, n + (2 * j + 3) % n):
            h = mix(h * _U(0xD6E8FEB86659FD93) ^ sig[:, v])
        keys[:, j] = h
    return keys


def _digests(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit digests of each set."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0xE7037ED1A0B428DB):
        sums = np.concatenate([[_U(0)], np.cumsum(mix(sets ^ _U(salt)), dtype=_U)])
        out.append(mix((sums[bounds[1:]] - sums[bounds[:-1]]) + np.diff(bounds).astype(_U)))
    return out[0], out[1]


def _sets(batch: pa.RecordBatch, column: int, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with their sets."""
    data, offs = string_buffers(batch.column(column))
    for lo, hi in slices(offs, BATCH_BYTES):
        part = LOWER[data[offs[lo] : offs[hi]]]
        _, _, hashes, first = words(part, offs[lo : hi + 1] - offs[lo])
        yield lo, hi, *shingles(hashes, first, k)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _sign(k: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets, bounds in _sets(batch, 1, k):
                keys = band_keys(signatures(sets, bounds, bands), bands)
                first, second = _digests(sets, bounds)
                own = [batch.column(i).slice(lo, hi - lo) for i in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.diff(bounds)), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), _lists(keys.ravel(), np.arange(hi - lo + 1) * bands)],
                    names=["id", "hash", "other", "n", "d1", "d2", "bands"],
                )

    return given_back(run)


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)  # of repeated rows a task gives the set once
        for batch in batches:
            wanted = [batch.column(i).to_numpy() for i in (2, 3)]
            for lo, hi, sets, bounds in _sets(batch, 1, k):
                # an id may stand for several texts: only the node's own text counts
                own = np.logical_and.reduce([d.view(np.int64) == w[lo:hi] for d, w in zip(_digests(sets, bounds), wanted, strict=True)])
                node = batch.column(0).slice(lo, hi - lo)
                number = node.to_numpy()
                at = np.flatnonzero(own & ~np.isin(number, seen))
                at = at[np.unique(number[at], return_index=True)[1]]
                own = np.zeros(hi - lo, bool)
                own[at] = True
                seen = np.union1d(seen, number[at])
                yield pa.RecordBatch.from_arrays([node, _lists(sets, bounds)], names=["node", "set"]).filter(pa.array(own))

    return given_back(run)


def _finish(percent: int):
    """Links between components from a block of strays and members of a bucket."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        band = key[0].as_py()
        stray = table.column("stray").to_numpy()
        comp = table.column("comp").to_numpy()
        size = table.column("n").to_numpy()
        bands = np.stack(table.column("bands").to_numpy())
        sets = [np.asarray(s).view(_U) for s in table.column("set").to_numpy()]
        members = np.flatnonzero(~stray)
        label = {int(c): int(c) for c in comp}

        def root(c: int) -> int:
            while label[c] != c:
                label[c] = c = label[label[c]]
            return c

        links = []
        for i in np.flatnonzero(stray):
            own = root(int(comp[i]))
            least, most = np.minimum(size[members], size[i]), np.maximum(size[members], size[i])
            near = members[(100 * least >= percent * most) & (comp[members] != comp[i])]
            shared = bands[near] == bands[i]
            near = near[~shared[:, :band].any(axis=1)]
            near = [j for j in near.tolist() if root(int(comp[j])) != own]
            if near:
                many = np.concatenate([sets[j] for j in near])
                at = np.searchsorted(sets[i], many)
                at[at == len(sets[i])] = 0
                starts = np.cumsum([0, *(len(sets[j]) for j in near[:-1])])
                common = np.add.reduceat((sets[i][at] == many).astype(np.int64), starts)
                for j, c in zip(near, common.tolist(), strict=True):
                    if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                        a, b = root(int(comp[i])), root(int(comp[j]))
                        if a != b:
                            label[max(a, b)] = min(a, b)
                            links.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _linked(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    left = edges.join(sets.select(F.col("node").alias("a"), F.col("set").alias("own")).hint("merge"), "a")
    both = left.join(sets.select(F.col("node").alias("b"), "set").hint("merge"), "b").withColumn("common", F.size(F.array_intersect("own", "set")))
    return both.where(100 * F.col("common") >= percent * (F.size("own") + F.size("set") - F.col("common"))).select("a", "b")


def _pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of members and their buckets' hubs whose sizes allow a link."""
    rows = buckets.select("node", "n", F.explode(F.array("hub", "other")).alias("h"))
    enough = 100 * F.least("n", "h.n") >= percent * F.greatest("n", "h.n")
    return rows.where((F.col("node") != F.col("h.node")) & enough).select(F.least("node", "h.node").alias("a"), F.greatest("node", "h.node").alias("b")).distinct()


def _strays(buckets: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (band, key, node, comp) of buckets of more than two, and the buckets whose members have several components.

    Of these: the largest component and the number of strays, the members outside it.
    """
    members = written(buckets.where("size > 2").join(roots, "node", "left").select("band", "key", "node", "n", F.coalesce("root", "node").alias("comp")), "minhash-members")
    parts = members.groupBy("band", "key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("least"))
    largest = F.max(F.struct("c", "comp", "w"))
    open_ = parts.groupBy("band", "key").agg(largest.alias("main"), F.sum("c").alias("size"), F.sum("w").alias("wide"), F.bit_xor("x").alias("x"), F.min("least").alias("least")).where("size > main.c")
    # buckets of several bands may have the same members: the first band's is enough
    once = open_.groupBy("size", "x", "least").agg(F.min(F.struct("band", "key", "main", "wide")).alias("s"))
    once = once.select("s.band", "s.key", F.col("s.main.comp").alias("main"), "size", "s.wide", (F.col("size") - F.col("s.main.c")).alias("strays"), (F.col("s.wide") - F.col("s.main.w")).alias("strays_wide"))
    return members, written(once, "minhash-open")


def _rest(members: DataFrame, once: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Step 3: links (a, b) between components of buckets that have several."""
    blocks = F.ceil(F.greatest(F.col("strays") / STRAYS, F.col("strays_wide") / BLOCK_SHINGLES)).cast("int")
    chunks = F.ceil(F.greatest(F.col("size") / MEMBERS, F.col("wide") / BLOCK_SHINGLES)).cast("int")
    rows = members.join(once.hint("merge"), ["band", "key"]).withColumn("at", F.xxhash64("node", F.lit(7)))
    stray = rows.where("comp <> main").select("band", "key", "node", "comp", F.lit(True).alias("stray"), F.pmod("at", blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
    rest = rows.select("band", "key", "node", "comp", F.lit(False).alias("stray"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.pmod("at", chunks).cast("int").alias("chunk"))
    full = stray.unionByName(rest).join(nodes.select("node", "n", "bands").hint("merge"), "node").join(sets.hint("merge"), "node")
    return full.groupBy("band", "key", "block", "chunk").applyInArrow(_finish(percent), "a long, b long")


def _groups(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, hash, other, n, component_id, stays): hashes of the text, its set's size, and whether it stands for its group."""
    bands = bands_for(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    hashed = texts.select("id", "text", *_text_hashes(F.col("text")))
    signed = written(hashed.mapInArrow(_sign(k, bands), "id long, hash long, other long, n long, d1 long, d2 long, bands array<long>"), "minhash-signed")
    nodes = signed.where("n > 0 AND id IS NOT NULL").groupBy("d1", "d2", "n").agg(F.min("id").alias("least_id"), F.first("bands").alias("bands"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    placed = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    # one hub for all buckets of a text, as far as it goes, and one by chance in each band
    first_hub, other_hub = (F.min_by(F.struct("node", "n"), h) for h in (F.xxhash64("node"), F.xxhash64("node", "band")))
    hubs = placed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), first_hub.alias("hub"), other_hub.alias("other")).where("size > 1")
    hubs = written(hubs, "minhash-hubs")
    buckets = written(placed.join(hubs.hint("merge"), ["band", "key"]), "minhash-buckets")
    forget(hubs)
    wanted = buckets.select("node").distinct().join(nodes.select("node", "d1", "d2", F.col("least_id").alias("id")), "node")
    sets = written(texts.join(wanted.hint("merge"), "id").select("node", "text", "d1", "d2").mapInArrow(_full_sets(k), "node long, set array<long>"), "minhash-sets")
    first = connected_components(_linked(_pairs(buckets, percent), sets, percent))
    members, once = _strays(buckets, first)
    more = connected_components(_rest(members, once, nodes, sets, percent))
    forget(buckets, sets, members, once)
    # the second components are of roots of the first, and of nodes that were alone
    joined = nodes.select("node", "d1", "d2", "n", "least_id").join(first, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")
    joined = joined.join(more.select(F.col("node").alias("part"), "root"), "part", "left").select("node", "d1", "d2", "n", "least_id", F.coalesce("root", "part").alias("root"))
    joined = written(joined, "minhash-labels")
    forget(first, more, nodes)
    # of several sets with the group's smallest id one stands for it, whatever the numbers of the nodes
    smallest = written(joined.groupBy("root").agg(F.min(F.struct("least_id", "d1", "d2", "n")).alias("best")), "minhash-smallest")
    labels = joined.join(smallest, "root").select("d1", "d2", "n", F.col("best.least_id").alias("component_id"), (F.struct("d1", "d2", "n") == F.struct("best.d1", "best.d2", "best.n")).alias("own"))
    out = signed.drop("bands").join(labels.hint("merge"), ["d1", "d2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    stays = F.col("id").eqNullSafe(component) & (F.col("id").isNull() | (F.col("n") == 0) | F.col("own"))
    return out.select("id", "hash", "other", "n", component.alias("component_id"), stays.alias("stays"))


def _text_hashes(text: Column) -> tuple[Column, Column]:
    """Two hashes that tell apart the texts of rows with one id."""
    return F.xxhash64(text).alias("hash"), F.xxhash64(F.lit(1), text).alias("other")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id of its group), kept."""
    out = _groups(docs, k, percent, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows of a near-duplicate group but the one with the smallest id; all columns as they were."""
    gone = _groups(docs, k, percent, id_col, text_col).where(~F.col("stays")).select("id", "hash", "other").distinct().alias("b")
    hash_, other = _text_hashes(F.col(f"a.{text_col}").cast("string"))
    same = (F.col(f"a.{id_col}").cast("long") == F.col("b.id")) & (hash_ == F.col("b.hash")) & (other == F.col("b.other"))
    return docs.alias("a").join(gone.hint("merge"), same, "left_anti")
