"""Hashed maximum-entropy language model with a class-factored softmax.

A token's probability is a product of softmaxes down a tree of classes that has
all known words as its leaves.  The most frequent words are in classes by their
rank.  Every other word is in a group by the hash of its last two bytes, in it
in a bucket and in the bucket in a part by its own hash, and the words of a part
are in classes by their rank.  Each softmax has the logs of the counts as its
biases and features of the context, which are learned by gradient updates:

* the group (or class of frequent words): the word before (2-gram), the one
  before that and the one before that (skips), both words before, hashed (3-gram);
* the frequent word or bucket: the word before and the one before that;
* class in the part and word in the class: the word before (2-gram), and both
  words before (3-gram), as words themselves, hashed; a pair of a class and a
  context is a feature if the training texts have it ``LEAST_SEEN`` times.

On the first two levels a context word is a frequent word or a group.  Which
part of a bucket is by counts alone.  All of it sums to 1 over the known words
and one unknown word a part.

Sizes follow the counts (``sizes_for``).  The two upper levels' tables are held
by every task and grow with roots of the distinct words and word pairs.  The
features below are as many as the corpus has; they are learned where their words
are: the tokens of a part meet in one shard, and the numbers of parts and of
shards grow in proportion to the words and tokens.

1. Counts: words of all training texts, as hashes, by partial aggregation, with
   a sample of the hashes of word pairs.  The driver gets the frequent words and
   the sums of each bucket.
2. Training of the upper levels: texts are dealt to shards of ``TRAIN_TOKENS`` by
   a digest of id and text and put in its order; each shard makes gradient
   updates over its texts, and the tables are averaged row by row, weighted by
   how often a shard saw the row's feature, shard after shard.
3. One pass over all texts scores the upper levels in numpy batches; tokens that
   aren't frequent words leave, packed, for their part's shard with their two
   words before.  The shard counts its words, learns from the tokens of training
   texts, and scores all of them; each batch of texts then gets its sums back.

Nothing depends on the number of cores or partitions: shards are cut by digests
and their sizes, and sums are made in a fixed order.

Words are runs without white space, A-Z lower-cased; each text has an end
token.  Words are told apart by 64-bit hashes on the driver and by 48 bits and
their group in a shard.

Defined results: a null text is the empty text, with its end token only.
Without training texts all counts are 0, ``base_score`` is 0 and all classes
are equally likely.  A null id counts as the empty text in the fold's crc32.
Repeated rows are scored, and counted, one by one; an empty table gives an
empty table.  Only the id and text columns are read, so other columns may have
any name.  Memory: an Arrow batch, a few arrays over ``BATCH_BYTES`` of text or
the longest text, the upper levels' tables, and a shard: its texts in step 2, its
tokens and their features in step 3.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, forget, given_back, given_back_each, slices, string_buffers, written
from .textscan import LOWER, mix, words

#: Sizes of a small corpus, and the least of a large one.
CLASS_WORDS, FREQUENT_CLASSES, RARE_CLASSES = 32, 16, 24
FREQUENT = CLASS_WORDS * FREQUENT_CLASSES
#: Symbols of a context: frequent words, rare classes, and the start of the text.
SYMBOLS = FREQUENT + RARE_CLASSES + 1
HASHED = 1 << 14
BATCH_BYTES = 2 << 20
#: Tokens of a training shard (or the longest text's), of a gradient update, and the step's size.
TRAIN_TOKENS = 8 << 20
UPDATE, RATE = 8192, 0.1
#: Tables are added up in pieces, so many to a table, from so many shards in one task.
CHUNKS, FAN = 64, 64
#: Tokens that are counted before their counts leave a task.
COUNTED = 4 << 20
#: Of the word pairs' hashes one in so many is counted.
PAIR_SAMPLE = 1024
#: Expected training tokens of a shard of parts, words of a part, and times that training texts have a feature of it.
EVENTS, PART_WORDS, LEAST_SEEN = 1 << 20, 1024, 1
#: Tokens of a shard whose parts are learned at once, of a gradient update in them, its step, and passes.
AT_ONCE = 1 << 18
PART_UPDATE, PART_RATE, PART_EPOCHS = 1024, 0.7, 1
#: Marks the documents that are only scored.
HELD = np.uint32(1 << 31)
END = np.uint64(0xE0D0E0D0E0D0E0D1)
_U, _F = np.uint64, np.float32


@dataclass(frozen=True)
class Sizes:
    """Sizes of the upper levels: words of a class (and buckets of a group), classes of frequent words, hashed rows."""

    class_words: int = CLASS_WORDS
    frequent_classes: int = FREQUENT_CLASSES
    hashed: int = HASHED

    @property
    def frequent(self) -> int:
        return self.class_words * self.frequent_classes

    @property
    def classes(self) -> int:
        return self.frequent_classes + RARE_CLASSES

    @property
    def symbols(self) -> int:
        return self.frequent + RARE_CLASSES + 1

    @property
    def class_rows(self) -> int:
        return 1 + 3 * self.symbols + self.hashed

    @property
    def word_rows(self) -> int:
        return self.classes * (1 + 2 * self.symbols)


def sizes_for(distinct: int, pairs: int) -> Sizes:
    """Frequent words by the fourth root of the distinct words, in classes twice as wide as many; hashed rows by the cube root of the word pairs.

    The words' table is the largest: it grows with the square root of the
    distinct words, to some 150 MB at a milliard of them.
    """
    width = max(CLASS_WORDS, math.ceil(CLASS_WORDS * (distinct / (1 << 19)) ** 0.125))
    classes = max(FREQUENT_CLASSES, math.ceil(width / 2))
    hashed = max(HASHED, 1 << math.ceil(math.log2(64 * max(pairs, 1) ** (1 / 3))))
    return Sizes(width, classes, hashed)


class Tokens:
    """Hashes, rare classes and bounds of the tokens of texts, end tokens included."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        starts, ends, hashes, first = words(data, offsets)
        n = len(offsets) - 1
        counts = np.diff(first)
        self.first = first + np.arange(n + 1)
        doc = np.repeat(np.arange(n), counts)
        at = np.arange(len(hashes)) + doc
        self.hash = np.full(len(hashes) + n, END, _U)
        self.hash[at] = hashes
        last = data[ends - 1].astype(np.int32)
        before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int32)
        self.rare = np.zeros(len(self.hash), np.int32)
        self.rare[at] = (last * 769 + before * 12289 >> 3) % RARE_CLASSES
        self.place = np.arange(len(self.hash)) - np.repeat(self.first[:-1], counts + 1)


class Head:
    """The frequent words in order of rank, sums over all words, and the weight of each bucket."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, in_bucket: np.ndarray, words_in: np.ndarray, sizes: Sizes = Sizes()):
        self.sizes = sizes
        self.rank = np.argsort(hashes)
        self.hash, self.count = hashes[self.rank], counts[self.rank]
        self.tokens, self.distinct = tokens, distinct
        self.absent = np.arange(sizes.frequent) >= len(hashes)
        # tokens and distinct words of each group's buckets, the frequent words not among them
        enough = np.maximum(words_in.sum(axis=1) / (sizes.class_words * PART_WORDS), in_bucket.sum(axis=1) / (sizes.class_words * EVENTS / 4))
        self.parts = np.maximum(1, np.ceil(enough)).astype(np.int64)
        self.mass = in_bucket + words_in + self.parts[:, None]
        top = np.pad(counts, (0, sizes.frequent - len(counts))) + 1.0
        mass = np.concatenate([top.reshape(-1, sizes.class_words), self.mass])
        whole = mass.sum(axis=1)
        self.prior = np.log(whole / whole.sum()).astype(_F), np.log(mass / whole[:, None]).astype(_F)

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each frequent word, -1 of all others."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.hash, hashes)
        at[at == len(self.hash)] = 0
        return np.where(self.hash[at] == hashes, self.rank[at], -1)


class Context:
    """Class, word in its class and feature rows of each token."""

    def __init__(self, tokens: Tokens, head: Head):
        self.rank = head.ranks(tokens.hash)
        self.is_frequent = self.rank >= 0
        z = head.sizes
        symbol = np.where(self.is_frequent, self.rank, z.frequent + tokens.rare).astype(np.int32)
        self.cls = np.where(self.is_frequent, self.rank // z.class_words, z.frequent_classes + tokens.rare).astype(np.int32)
        # the frequent word in its class, or the bucket in the group
        self.word = np.where(self.is_frequent, self.rank % z.class_words, bucket(tokens.hash, z.class_words)).astype(np.int32)

        def back(k: int) -> np.ndarray:
            out = np.full(len(symbol), z.symbols - 1, np.int32)
            out[k:] = symbol[: len(symbol) - k]
            out[tokens.place < k] = z.symbols - 1
            return out

        s1, s2 = back(1), back(2)
        # rows are written where they stay, one feature after the other
        self.class_rows = np.zeros((5, len(symbol)), _rows_type(z.class_rows))
        self.class_rows[1], self.class_rows[2], self.class_rows[3] = 1 + s1, 1 + z.symbols + s2, 1 + 2 * z.symbols + back(3)
        self.class_rows[4] = (mix(s1.astype(_U) * _U(z.symbols) + s2.astype(_U)) >> _U(65 - z.hashed.bit_length())).astype(np.int32) + (1 + 3 * z.symbols)
        self.word_rows = np.empty((3, len(symbol)), _rows_type(z.word_rows))
        self.word_rows[0], self.word_rows[1] = self.cls, z.classes + s1 * z.classes + self.cls
        self.word_rows[2] = z.classes * (1 + z.symbols) + s2 * z.classes + self.cls


def _rows_type(rows: int) -> type:
    """Short numbers of rows are sorted faster."""
    return np.uint16 if rows <= 1 << 16 else np.int32


def bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> _U(24)) % _U(buckets)).astype(np.int64)


def part(hashes: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Part of its bucket, of so many."""
    return ((hashes >> _U(40)) % parts.astype(_U)).astype(np.int64)


def _softmax(x: np.ndarray) -> np.ndarray:
    """In place, of logits whose biases are logs of shares: none is far above 0, and in each row one isn't far below."""
    if x.max(initial=0) > 80:
        np.minimum(x, _F(80), out=x)
    np.exp(x, out=x)
    x *= (1 / np.maximum(np.einsum("ij->i", x), _F(1e-30)))[:, None]
    return x


class Model:
    """Feature tables of the two softmaxes."""

    def __init__(self, head: Head):
        self.sizes = sizes = head.sizes
        self.tables = [np.zeros((sizes.class_rows, sizes.classes), _F), np.zeros((sizes.word_rows, sizes.class_words), _F)]
        self.tables[0][0], self.tables[1][: sizes.classes] = head.prior
        # words that a class of frequent words hasn't, in a small corpus, and classes without any
        absent = head.absent.reshape(sizes.frequent_classes, sizes.class_words)
        self.no_word = np.zeros((sizes.classes, sizes.class_words), _F)
        self.no_word[: sizes.frequent_classes][absent & ~absent.all(axis=1, keepdims=True)] = -1e9
        self.no_class = np.zeros(sizes.classes, _F)
        self.no_class[: sizes.frequent_classes][absent.all(axis=1)] = -1e9

    def classes(self, rows: np.ndarray) -> np.ndarray:
        x = self.tables[0].take(rows[0], axis=0)
        for r in rows[1:]:
            x += self.tables[0].take(r, axis=0)
        x += self.no_class
        return _softmax(x)

    def words(self, rows: np.ndarray) -> np.ndarray:
        x = self.tables[1].take(rows[0], axis=0)
        for r in rows[1:]:
            x += self.tables[1].take(r, axis=0)
        x += self.no_word.take(rows[0], axis=0)
        return _softmax(x)

    def log_probability(self, c: Context) -> np.ndarray:
        """Natural log of each token's class probability times that of the frequent word or the bucket in it."""
        out = np.empty(len(c.cls))
        for lo in range(0, len(out), UPDATE):
            own = slice(lo, min(lo + UPDATE, len(out)))
            p, q = self.classes(c.class_rows[:, own]), self.words(c.word_rows[:, own])
            at = np.arange(len(p))
            out[own] = np.log(np.maximum(p[at, c.cls[own]], 1e-30)) + np.log(np.maximum(q[at, c.word[own]], 1e-30))
        return out


class Trainer(Model):
    """A shard's model, its gradient updates and how often each row was seen."""

    def __init__(self, head: Head):
        super().__init__(head)
        self.squares = [np.ones(len(t), _F) for t in self.tables]
        self.seen = [np.zeros(len(t)) for t in self.tables]

    def _push(self, which: int, rows: np.ndarray, error: np.ndarray) -> None:
        for r in rows:
            at, times = step(self.tables[which], self.squares[which], r, error, RATE)
            self.seen[which][at] += times

    def update(self, c: Context) -> None:
        for lo in range(0, len(c.cls), UPDATE):
            own = slice(lo, min(lo + UPDATE, len(c.cls)))
            for which, softmax, rows, target in ((0, self.classes, c.class_rows, c.cls), (1, self.words, c.word_rows, c.word)):
                error = softmax(rows[:, own])
                error[np.arange(len(error)), target[own]] -= 1
                self._push(which, rows[:, own], error)


def _sums(error: np.ndarray, order: np.ndarray, starts: np.ndarray, times: np.ndarray, few: int = 4) -> np.ndarray:
    """Sums of the rows ``error[order]`` from each start on; ``reduceat`` does only what is behind the first few of a sum."""
    g = error.take(order[starts], axis=0)
    for k in range(1, few):
        more = np.flatnonzero(times > k)
        if not len(more):
            return g
        g[more] += error.take(order[starts[more] + k], axis=0)
    more = np.flatnonzero(times > few)
    if len(more):
        rest = times[more] - few
        ends = np.cumsum(rest)
        at = np.repeat(starts[more] + few - (ends - rest), rest) + np.arange(ends[-1])
        g[more] += np.add.reduceat(error.take(order[at], axis=0), ends - rest, axis=0)
    return g


def step(table: np.ndarray, squares: np.ndarray, r: np.ndarray, error: np.ndarray, rate: float, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A gradient step of the rows ``r``, in their first columns; the distinct rows and how often each is in ``r``.

    With ``order``, ``r`` is sorted already, and ``order`` has the errors' places.
    """
    if r[0] == r[-1] and (r == r[0]).all():  # the bias of all
        at, times, g = r[:1], np.array([len(r)]), error.sum(axis=0, keepdims=True)
    else:
        if order is None:
            order = np.argsort(r, kind="stable")
            r = r[order]
        starts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        at, times = r[starts], np.diff(np.append(starts, len(r)))
        g = _sums(error, order, starts, times)
    new = squares.take(at) + np.einsum("ij,ij->i", g, g) / _F(g.shape[1])
    squares[at] = new
    g *= (_F(-rate) / np.sqrt(new))[:, None]
    rows = table.take(at, axis=0)
    rows[:, : g.shape[1]] += g
    table[at] = rows
    return at, times


class Level:
    """A softmax at each node of one level of the parts: class in the part, or word in the class.

    A node's biases are the logs of its places' weights; each pair of a node and
    a context word that the training tokens have ``LEAST_SEEN`` times has a row of
    its own.  Tokens without such a pair have the biases' probability.
    """

    def __init__(self, node: np.ndarray, digit: np.ndarray, contexts: list[np.ndarray], learn: np.ndarray, weight: np.ndarray, wide: np.ndarray):
        with np.errstate(divide="ignore"):
            logs = np.log(weight / np.maximum(weight.sum(axis=1, keepdims=True), 1))
        self.bias, self.plain = np.maximum(logs, -1e9).astype(_F), logs[node, digit]
        rows, self.tables = [], []
        for c in contexts:
            key = (node.astype(_U) << _U(24)) | c.astype(_U)
            order = np.argsort(key)
            key = key[order]
            new = np.diff(key, prepend=~key[:1]) != 0
            known = np.add.reduceat(learn[order], np.flatnonzero(new), dtype=np.int64) >= LEAST_SEEN if len(key) else np.zeros(0, bool)
            n = np.count_nonzero(known)
            # the row after the last is of all other contexts, and stays 0
            row = np.empty(len(key), np.int64)
            row[order] = np.where(known, np.cumsum(known) - 1, n)[np.cumsum(new) - 1]
            rows.append(row)
            self.tables.append(np.zeros((n + 1, weight.shape[1]), _F))
        self.squares = [np.full(len(t), 0.1, _F) for t in self.tables]
        self.at = np.flatnonzero(np.logical_or.reduce([r < len(t) - 1 for r, t in zip(rows, self.tables, strict=True)]))
        self.node, self.digit, self.wide, self.rows = node[self.at], digit[self.at], wide[self.at], [r[self.at] for r in rows]

    def softmax(self, own: np.ndarray) -> np.ndarray:
        """Probabilities of the places that these tokens' nodes have, at most."""
        w = int(self.wide[own].max())
        x = np.ascontiguousarray(self.bias.take(self.node[own], axis=0)[:, :w])
        for rows, table in zip(self.rows, self.tables, strict=True):
            x += table.take(rows[own], axis=0)[:, :w]
        return _softmax(x)

    def learn(self, order: np.ndarray) -> None:
        """Gradient updates over tokens of ``at``, by their place in it."""
        update, place = np.divmod(np.arange(len(order)), PART_UPDATE)
        bits = (PART_UPDATE - 1).bit_length()
        by_row = []  # of all updates at once: their tokens in the order of rows
        for rows, table in zip(self.rows, self.tables, strict=True):
            key = (update * len(table) + rows[order]) << bits | place
            key.sort()
            by_row.append(((key >> bits) % len(table), key & (1 << bits) - 1))
        for lo in range(0, len(order), PART_UPDATE):
            some = slice(lo, lo + PART_UPDATE)
            own = order[some]
            error = self.softmax(own)
            error[np.arange(len(own)), self.digit[own]] -= 1
            for (rows, places), table, squares in zip(by_row, self.tables, self.squares, strict=True):
                step(table, squares, rows[some], error, PART_RATE, places[some])
                table[-1] = 0

    def log_probability(self) -> np.ndarray:
        out = self.plain.copy()
        for lo in range(0, len(self.at), PART_UPDATE):
            own = np.arange(lo, min(lo + PART_UPDATE, len(self.at)))
            out[self.at[own]] = np.log(np.maximum(self.softmax(own)[np.arange(len(own)), self.digit[own]], 1e-30))
        return out


def part_scores(leaf: np.ndarray, word: np.ndarray, one: np.ndarray, two: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token of a shard: natural log of its probability in its part times the part's weight, and count of its word.

    ``word`` has 48 bits, ``one`` and ``two`` are 24 bits of the words before.
    A word that training hasn't is the part's unknown word.
    """
    _, leaf = np.unique(leaf, return_inverse=True)
    parts = int(leaf.max()) + 1 if len(leaf) else 0
    # part by part, whose rows are near each other, and in it in an order that depends on the content only
    mixed = mix(mix(word) + ((one.astype(_U) << _U(24)) | two)) >> _U(16)
    back = np.argsort((leaf.astype(_U) << _U(48)) | mixed, kind="stable")
    leaf, word, one, two, learn = (x[back] for x in (leaf, word, one, two, learn))
    key = (leaf.astype(_U) << _U(48)) | word
    names, name = np.unique(key, return_inverse=True)
    count = np.bincount(name[learn], minlength=len(names))
    at = (names >> _U(48)).astype(np.int64)
    known = count > 0
    words_in = np.bincount(at[known], minlength=parts)
    # the rank of a known word in its part; the unknown word comes after them
    order = np.lexsort((names, -count, at))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names)) - np.searchsorted(at, np.arange(parts))[at[order]]
    rank = np.where(known, rank, words_in[at])
    wide = np.ceil(np.sqrt(words_in + 1)).astype(np.int64)
    most = int(wide.max(initial=1))
    cls, digit = rank // wide[at], rank % wide[at]
    weight = np.zeros((parts * most, most))
    weight[(at * most + cls)[known], digit[known]] = count[known] + 1
    last = words_in // wide
    weight[np.arange(parts) * most + last, words_in - last * wide] = 1
    outer = weight.sum(axis=1).reshape(parts, most)
    cls, digit = cls[name], digit[name]
    out = np.log(outer.sum(axis=1))[leaf]
    both = (mix((one.astype(_U) << _U(24)) | two) >> _U(40)).astype(np.uint32)
    for node, place, w in ((leaf, cls, outer), (leaf * most + cls, digit, weight)):
        level = Level(node, place, [one, both], learn, w, wide[leaf])
        own = np.flatnonzero(learn[level.at])
        for _ in range(PART_EPOCHS):
            level.learn(own)
        out += level.log_probability()
        del level, own  # before the next level has its tables
    logs, counts = np.empty_like(out), np.empty_like(count[name])
    logs[back], counts[back] = out, count[name]
    return logs, counts


def _by_parts(leaf: np.ndarray, *tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``part_scores`` of a shard, some parts of ``AT_ONCE`` tokens (or one part) at a time."""
    order = np.argsort(leaf, kind="stable")
    bounds = np.flatnonzero(np.diff(leaf[order], prepend=-1, append=-1))
    logs, counts = np.empty(len(leaf)), np.empty(len(leaf), np.int64)
    for lo, hi in slices(bounds, AT_ONCE):
        own = order[bounds[lo] : bounds[hi]]
        logs[own], counts[own] = part_scores(leaf[own], *(x[own] for x in tokens))
    return logs, counts


def _each(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, int, Tokens]]:
    for batch in batches:
        data, offs = string_buffers(batch.column(column))
        for lo, hi in slices(offs, BATCH_BYTES):
            yield batch, lo, hi, Tokens(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # distinct words, rare classes and counts of each slice of texts: far fewer than its tokens
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    pairs: list[np.ndarray] = []
    size = 0

    def out() -> pa.RecordBatch:
        hashes, rare, times = (np.concatenate([h[i] for h in held]) for i in range(3))
        held.clear()
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        distinct, rare, counts = hashes[starts], rare[order[starts]], np.add.reduceat(times[order], starts, dtype=np.int64)
        # word pairs of the sample have no rare class
        pair = np.unique(np.concatenate(pairs))
        pairs.clear()
        distinct, counts = np.concatenate([distinct, pair]), np.concatenate([counts, np.ones(len(pair), np.int64)])
        rare = np.concatenate([rare, np.full(len(pair), -1, rare.dtype)])
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(rare.astype(np.int64)), pa.array(counts)], names=["hash", "rare", "n"])

    for _, _, _, tokens in _each(batches, 0):
        distinct, at, times = np.unique(tokens.hash, return_index=True, return_counts=True)
        held.append((distinct, tokens.rare[at].astype(np.int8), times.astype(np.int32)))
        pair = mix(tokens.hash[1:] * _U(0xD6E8FEB86659FD93) + tokens.hash[:-1])[tokens.place[1:] > 0]
        pairs.append(pair[pair % _U(PAIR_SAMPLE) == 0])
        size += len(tokens.hash)
        if size >= COUNTED:
            yield out()
            size = 0
    if held:
        yield out()


def _train(head: Head):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        trainer = Trainer(head)
        order, texts = pa.compute.sort_indices(table, sort_keys=[("digest", "ascending")]), table.select(["text"])
        some = (b for lo in range(0, len(order), 1024) for b in texts.take(order.slice(lo, 1024)).combine_chunks().to_batches())
        for _, _, _, tokens in _each(some, 0):
            trainer.update(Context(tokens, head))
        cols: list[list] = [[] for _ in range(4)]
        for which, (own, seen) in enumerate(zip(trainer.tables, trainer.seen, strict=True)):
            for k, rows in enumerate(np.array_split(np.arange(len(own)), CHUNKS)):
                weighted = (own[rows] * seen[rows, None]).astype(_F)
                for col, v in zip(cols, (which, k, weighted.tobytes(), seen[rows].tobytes()), strict=True):
                    col.append(v)
        return _pieces(key[0].as_py(), *cols)

    return given_back_each(run)


def _pieces(shard: int, which: list[int], chunk: list[int], sums: list[bytes], seen: list[bytes]) -> pa.Table:
    return pa.table({"shard": pa.array([shard] * len(which), pa.int64()), "which": pa.array(which, pa.int32()), "chunk": pa.array(chunk, pa.int32()), "sums": pa.array(sums, pa.binary()), "seen": pa.array(seen, pa.binary())})


def _add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("shard")
    sums = sum(np.frombuffer(b, _F).astype(np.float64) for b in table.column("sums").to_pylist())
    seen = sum(np.frombuffer(b, np.float64) for b in table.column("seen").to_pylist())
    which, chunk, some = (k.as_py() for k in key)
    return _pieces(some, [which], [chunk], [sums.astype(_F).tobytes()], [seen.tobytes()])


_PIECES = "shard long, which int, chunk int, sums binary, seen binary"


def train(texts: DataFrame, head: Head) -> Model:
    """Model averaged from gradient updates over all rows of ``texts`` (id, text)."""
    model = Model(head)
    shards = max(1, math.ceil(head.tokens / TRAIN_TOKENS))
    digest = F.xxhash64("id", "text")
    dealt = texts.select(F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(shards)).alias("shard"), digest.alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    parts = dealt.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(_train(head), _PIECES)
    while True:  # no task holds a piece of more than FAN shards
        parts = parts.withColumn("some", F.floor(F.col("shard") / FAN).cast("long")).groupBy("which", "chunk", "some").applyInArrow(given_back_each(_add), _PIECES)
        shards = math.ceil(shards / FAN)
        if shards == 1:
            break
    for row in parts.toLocalIterator():  # the upper levels' tables, a piece at a time
        table = model.tables[row["which"]]
        rows = np.array_split(np.arange(len(table)), CHUNKS)[row["chunk"]]
        sums = np.frombuffer(row["sums"], _F).reshape(len(rows), -1)
        seen = np.frombuffer(row["seen"], np.float64)
        table[rows[seen > 0]] = sums[seen > 0] / seen[seen > 0, None]
    return model


#: A batch's documents, and its tokens packed for a shard (or what a shard says of them); ``base`` names the batch.
_DOCUMENT = ["id", "held", "n_tokens", "n_rare", "counted", "own"]
_MIXED = "key long, base long, n long, data binary, id long, held boolean, n_tokens long, n_rare long, counted double, own double"
_KINDS = pa.schema([("key", pa.int64()), ("base", pa.int64()), ("n", pa.int64()), ("data", pa.binary()), ("id", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_rare", pa.int64()), ("counted", pa.float64()), ("own", pa.float64())])


def _mixed(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(columns["base"])
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _KINDS], schema=_KINDS)


def _planes(values: np.ndarray, halves: int) -> bytes:
    """The lowest 16-bit halves of numbers, one after the other."""
    return b"".join((values >> values.dtype.type(16 * i)).astype(np.uint16).tobytes() for i in range(halves))


def _emit(head: Head, model: Model, shards: int):
    """Documents with the scores of the upper levels, and their other tokens packed by shard."""
    log_count = np.log(head.count[np.argsort(head.rank)] + 1.0)
    buckets = head.sizes.class_words

    def packed(batch: pa.RecordBatch, lo: int, hi: int, tokens: Tokens) -> Iterator[pa.RecordBatch]:
        c = Context(tokens, head)
        counted = np.where(c.is_frequent, log_count[c.rank] if len(log_count) else 0.0, 0.0)
        starts, n = tokens.first[:-1], hi - lo
        base = pa.array(np.full(n, batch.column(0)[lo].as_py(), np.int64))
        # documents go through the shards' shuffle as they are, under a key below 0 for each batch
        spread = -1 - batch.column(0)[lo].as_py()
        learn = batch.column(2).slice(lo, n).to_numpy(zero_copy_only=False).astype(bool)
        figures = [np.diff(tokens.first), np.add.reduceat((~c.is_frequent).astype(np.int64), starts), np.add.reduceat(counted, starts), np.add.reduceat(model.log_probability(c), starts)]
        own = [batch.column(1).slice(lo, n), pa.array(~learn), *map(pa.array, figures)]
        yield _mixed({"key": pa.array(np.full(n, spread)), "base": base, "n": pa.array(np.arange(n))} | dict(zip(_DOCUMENT, own, strict=True)))
        out = np.flatnonzero(~c.is_frequent)
        if not len(out):
            return
        word, group = tokens.hash[out] >> _U(16), tokens.rare[out]
        shard = (mix(_leaf(group, word, head.parts, buckets).astype(_U)) % _U(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        out, word, group, shard = out[order], word[order], group[order].astype(np.uint8), shard[order]
        before = []
        for k in (1, 2):
            hashes = np.where(tokens.place[out] < k, _U(0), tokens.hash[out - np.minimum(k, out)])
            before.append((hashes >> _U(40)).astype(np.uint32))
        doc = (np.searchsorted(tokens.first, out, side="right") - 1).astype(np.uint32)
        doc[~learn[doc]] |= HELD
        bounds = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        data = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            at = np.flatnonzero(np.diff(doc[a:b].astype(np.int64), prepend=-1))
            times = np.diff(np.append(at, b - a)).astype(np.uint32)
            heads = np.array([len(at)], np.uint32).tobytes() + doc[a:b][at].tobytes() + times.tobytes()
            contexts = b"".join(_planes(x[a:b], 1) + (x[a:b] >> np.uint32(16)).astype(np.uint8).tobytes() for x in before)
            data.append(heads + _planes(word[a:b], 3) + contexts + group[a:b].tobytes())
        yield _mixed({"key": pa.array(shard[bounds[:-1]]), "base": base.slice(0, 1).take(pa.array(np.zeros(len(data), np.int64))), "n": pa.array(np.diff(bounds)), "data": pa.array(data, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _each(batches, 3):
            yield from packed(*own)

    return given_back(run)


def _leaf(group: np.ndarray, word: np.ndarray, parts: np.ndarray, buckets: int) -> np.ndarray:
    """Number of a word's part among those of all buckets; ``word`` is the upper 48 bits of its hash."""
    hashes = word << _U(16)
    return (bucket(hashes, buckets) * (1 << 24) + part(hashes, parts[group])) * RARE_CLASSES + group


def _unpacked(n: int, data: pa.Buffer) -> list[np.ndarray]:
    """Documents, tokens of each, words, both words before, and groups."""
    docs = int(np.frombuffer(data, np.uint32, 1)[0])
    at = 4
    out = [np.frombuffer(data, np.uint32, docs, at), np.frombuffer(data, np.uint32, docs, at + 4 * docs)]
    at += 8 * docs
    word = np.frombuffer(data, np.uint16, 3 * n, at).reshape(3, n).astype(_U)
    out.append(word[0] | word[1] << _U(16) | word[2] << _U(32))
    at += 6 * n
    for _ in range(2):
        low, high = np.frombuffer(data, np.uint16, n, at), np.frombuffer(data, np.uint8, n, at + 2 * n)
        out.append(low | high.astype(np.uint32) << np.uint32(16))
        at += 3 * n
    return [*out, np.frombuffer(data, np.uint8, n, at)]


def _score_parts(head: Head):
    log_mass, buckets = np.log(head.mass), head.sizes.class_words

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Documents as they are; of a batch's tokens in a shard the sums of each document."""
        if key[0].as_py() < 0:
            return table
        table = table.sort_by("base")
        got = [_unpacked(n, d.as_buffer()) for n, d in zip(table.column("n").to_pylist(), table.column("data"), strict=True)]
        word, one, two, group = (np.concatenate([g[i] for g in got]) for i in range(2, 6))
        got = [g[:2] for g in got]
        learn = np.concatenate([np.repeat(docs < HELD, times) for docs, times in got])
        logs, count = _by_parts(_leaf(group, word, head.parts, buckets), word, one, two, learn)
        logs -= log_mass[group, bucket(word << _U(16), buckets)]
        figures, data, at = (logs, np.log(count + 1.0), (count > 0).astype(np.uint32)), [], 0
        for docs, times in got:
            starts = at + np.cumsum(times, dtype=np.int64) - times
            at += int(times.sum())
            sums = [np.add.reduceat(v[:at], starts) for v in figures]
            data.append((docs & ~HELD).tobytes() + sums[0].astype(_F).tobytes() + sums[1].tobytes() + sums[2].astype(np.uint32).tobytes())
        n = pa.array([len(g[0]) for g in got], pa.int64())
        return pa.Table.from_batches([_mixed({"key": table.column("key").combine_chunks(), "base": table.column("base").combine_chunks(), "n": n, "data": pa.array(data, pa.binary())})])

    return given_back_each(run)


def _gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Documents of a batch with the sums of all shards, added in the order of the shards."""
    packed = table.column("data").is_valid()
    docs, parts = table.filter(pa.compute.invert(packed)).sort_by("n"), table.filter(packed).sort_by("key")
    logs, counted, known = (np.zeros(len(docs)) for _ in range(3))
    for n, data in zip(parts.column("n").to_pylist(), parts.column("data"), strict=True):
        buffer = data.as_buffer()
        at = np.frombuffer(buffer, np.uint32, n)
        logs[at] += np.frombuffer(buffer, _F, n, 4 * n)
        counted[at] += np.frombuffer(buffer, np.float64, n, 8 * n)
        known[at] += np.frombuffer(buffer, np.uint32, n, 16 * n)
    own = {c: docs.column(c) for c in _DOCUMENT}
    n_known = own["n_tokens"].to_numpy() - own["n_rare"].to_numpy() + known.astype(np.int64)
    return pa.table({"id": own["id"], "held_out": own["held"], "n_tokens": own["n_tokens"], "n_known": pa.array(n_known), "counted": pa.array(own["counted"].to_numpy() + counted), "logs": pa.array(own["own"].to_numpy() + logs)})


def lm_scores(docs: DataFrame, train_row: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``train_row`` says, of the column ``id``, which rows to learn from; by
    default those whose crc32 (as text) modulo 7 isn't 2.  Scores are sums of
    log10 probabilities over a text's tokens.
    """
    train_row = crc32_mod("id", 7) != 2 if train_row is None else train_row
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    learned = rows.where(train_row)
    counted = written(learned.select("text").mapInArrow(given_back(_count), "hash long, rare long, n long").groupBy("hash").agg(F.min("rare").alias("rare"), F.sum("n").alias("n")), "lm-counts")
    counts = counted.where("rare >= 0")
    total, distinct, pairs = counted.select(
        F.coalesce(F.sum(F.when(F.col("rare") >= 0, F.col("n"))), F.lit(0)), F.count_if(F.col("rare") >= 0), F.count_if(F.col("rare") < 0) * PAIR_SAMPLE
    ).first()
    sizes = sizes_for(distinct, pairs)
    buckets = sizes.class_words
    # tokens and words of each bucket, a row for each bucket
    in_bucket, words_in = np.zeros((RARE_CLASSES, buckets)), np.zeros((RARE_CLASSES, buckets))
    own = F.pmod(F.shiftrightunsigned("hash", 24), F.lit(buckets)).alias("bucket")
    for r in counts.groupBy("rare", own).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        in_bucket[r["rare"], r["bucket"]], words_in[r["rare"], r["bucket"]] = r["n"], r["words"]
    top = counts.orderBy(F.col("n").desc(), "hash").limit(sizes.frequent).toArrow()  # the frequent words
    hashes, rare, n = (top.column(c).to_numpy() for c in ("hash", "rare", "n"))
    order = np.lexsort((hashes, -n))
    hashes, rare, n = hashes[order].view(_U), rare[order], n[order]
    np.subtract.at(in_bucket, (rare, bucket(hashes, buckets)), n)
    np.subtract.at(words_in, (rare, bucket(hashes, buckets)), 1)
    forget(counted)
    head = Head(hashes, n, total, distinct, in_bucket, words_in, sizes)
    model = train(learned, head) if total else Model(head)
    shards = max(1, math.ceil(in_bucket.sum() / EVENTS))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "id", F.coalesce(train_row, F.lit(False)).alias("learn"), "text")
    mixed = numbered.mapInArrow(_emit(head, model, shards), _MIXED)
    scored = mixed.repartition(2 * shards, "key").groupBy("key").applyInArrow(_score_parts(head), _MIXED)
    out = scored.groupBy("base").applyInArrow(given_back_each(_gather), "id long, held_out boolean, n_tokens long, n_known long, counted double, logs double")
    ln10 = float(np.log(10.0))
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("counted") / ln10 - F.col("n_tokens") * float(np.log10(total + distinct + 1.0))).alias("base_score"),
        (F.col("logs") / ln10).alias("score"),
    )
