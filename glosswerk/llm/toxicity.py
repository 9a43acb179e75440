"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Input of a step is a word: a learned vector of the word itself, if it is in
the vocabulary, and the mean of learned vectors of its characters (UTF-8
bytes).  Two gated recurrent units read a window of words in both directions,
attention pools their states, and a logistic unit scores the window.  Windows
overlap by half and cover the whole text; a text's score is that of its worst
window.  Words are runs of letters and digits, A-Z lower-cased.

The network is trained in numpy on the driver, on a bounded sample of labelled
rows: at most ``most_toxic`` and ``most_clean`` rows of the two classes, those
whose ids have the smallest digests, and ``most_characters`` of their texts in
all.  Only if the texts have more, the longest ones give pieces of
``PIECE`` characters at even distances instead of all their characters, so that
no row is left out for its length.  Since a label is of a text and not of a
window, each epoch trains on the windows that the network finds worst.  Nothing but the text
is an input, and all weights begin by chance.  Scoring reads every whole text; a batch's
memory is bounded by ``BATCH_BYTES`` or its longest text.

Defined results: a null text or one without words has one window without
words, and its score.  Of several texts of a labelled id one is trained on.  Labels that are null, or of ids that aren't among the
texts, aren't used; of several labels of an id the largest counts.  Without
labelled rows of both classes the score is the share of toxic rows, held
below 0.5.  Repeated rows share a score; an empty table gives an empty table.
Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, given_back, slices, string_buffers
from .textscan import LOWER, words

#: Training rows: most of class 1 and of class 0, the characters of all of them, and those of a piece of a text that is cut.
MOST_TOXIC, MOST_CLEAN, MOST_CHARACTERS, PIECE = 800, 2_400, 24 << 20, 2_048
#: Words of a window, and from one window's start to the next one's.
WINDOW, STRIDE = 24, 12
VOCABULARY, LEAST_TEXTS, LEAST_SHARE = 8_192, 3, 0.005
WORD_DIM, CHAR_DIM, STATE, ATTEND = 12, 6, 8, 8
LEAST_EPOCHS, LEAST_UPDATES, BATCH, RATE = 6, 300, 96, 0.01
#: The network's weights are a running mean of those of the updates, which keeps so much of itself.
AVERAGE = 0.99
BATCH_BYTES = 1 << 20

#: Lower case; whatever is neither a letter, a digit nor part of a longer character separates words.
_FOLD = LOWER.copy()
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 0x20
_F = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += _F(1)
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    x *= _F(2)
    x = _sigmoid(x)
    x *= _F(2)
    x -= _F(1)
    return x


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Texts:
    """Words of texts as vocabulary numbers and mean characters, cut into windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.bytes = _FOLD[data]
        self.starts, self.ends, self.hashes, first = words(self.bytes, offsets)
        counts = np.diff(first)
        # the last window ends with the text; texts that are shorter than a window have one
        extra = np.maximum(0, -(-(counts - WINDOW) // STRIDE))
        self.of = np.repeat(np.arange(len(counts)), extra + 1)
        self.first = np.cumsum(extra + 1) - (extra + 1)
        step = np.arange(len(self.of)) - self.first[self.of]
        at = np.minimum(step * STRIDE, np.maximum(counts[self.of] - WINDOW, 0))
        self.at = first[self.of] + at
        self.size = np.minimum(counts[self.of] - at, WINDOW)

    def only(self, pick: np.ndarray) -> Texts:
        """Some windows, with copies of their words."""
        out = object.__new__(Texts)
        word = _ranges(self.at[pick], self.size[pick])
        length = self.ends[word] - self.starts[word]
        out.bytes = self.bytes[_ranges(self.starts[word], length)]
        out.ends = np.cumsum(length)
        out.starts = out.ends - length
        out.hashes, out.of, out.size = self.hashes[word], self.of[pick], self.size[pick]
        out.at = np.cumsum(out.size) - out.size
        return out

    def between(self, lo: int, hi: int) -> Texts:
        """The windows from ``lo`` to ``hi``, whose words are one run, as views."""
        out = object.__new__(Texts)
        first, last = int(self.at[lo]), int((self.at[lo:hi] + self.size[lo:hi]).max())
        start = int(self.starts[first]) if first < last else 0
        out.bytes = self.bytes[start : int(self.ends[last - 1])] if first < last else self.bytes[:0]
        out.starts, out.ends = self.starts[first:last] - start, self.ends[first:last] - start
        out.hashes, out.of, out.size = self.hashes[first:last], self.of[lo:hi], self.size[lo:hi]
        out.at = self.at[lo:hi] - first
        return out

    def numbers(self, known: np.ndarray) -> np.ndarray:
        """Place of each word in the sorted hashes ``known``; 0, which is none of them, if it isn't there."""
        if not len(known):
            return np.zeros(len(self.hashes), np.int64)
        at = np.searchsorted(known, self.hashes)
        at[at == len(known)] = 0
        return np.where(known[at] == self.hashes, at + 1, 0)

    def characters(self, table: np.ndarray) -> np.ndarray:
        """Mean vector of each word's bytes."""
        if not len(self.starts):
            return np.zeros((0, table.shape[1]), _F)
        table = table.copy()
        table[[*range(0x09, 0x0E), 0x20]] = 0  # what lies between two words
        sums = np.add.reduceat(table[self.bytes], self.starts, axis=0)
        return sums / (self.ends - self.starts)[:, None].astype(_F)


class Network:
    """The network's arrays, its scores and its gradients."""

    def __init__(self, known: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        inputs = WORD_DIM + CHAR_DIM

        def init(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(_F)

        self.known = known
        self.p = {
            "word": init(len(known) + 1, WORD_DIM, scale=0.05),
            "char": init(256, CHAR_DIM, scale=0.1),
            "in": init(2, inputs, 3 * STATE, scale=inputs**-0.5),
            "bias": np.zeros((2, 3 * STATE), _F),
            "state": init(2, STATE, 3 * STATE, scale=STATE**-0.5),
            "attend": init(2 * STATE, ATTEND, scale=0.3),
            "query": init(ATTEND, scale=0.3),
            "out": init(2 * STATE, scale=0.3),
            "out_bias": np.zeros(1, _F),
        }

    def _inputs(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        number = texts.numbers(self.known)
        return number, texts.characters(self.p["char"])

    def _gates(self, number: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """(2, words + 1, gates): what each word puts into the gates of both directions; the last row is padding."""
        out = np.zeros((2, len(number) + 1, 3 * STATE), _F)
        for d in range(2):
            of_word = self.p["word"] @ self.p["in"][d][:WORD_DIM] + self.p["bias"][d]
            out[d, :-1] = of_word[number]
            out[d, :-1] += chars @ self.p["in"][d][WORD_DIM:]
        return out

    def logits(self, gates: np.ndarray, at: np.ndarray, size: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; with ``keep``, what the gradients need goes there."""
        steps = max(1, int(size.max(initial=1)))
        n, pad = len(at), gates.shape[1] - 1
        place = np.arange(steps)[:, None]
        inside = place < size
        index = np.where(inside, at + place, pad)
        mask = inside.astype(_F)[:, :, None]
        h = np.zeros((2, n, STATE), _F)
        states = np.empty((steps, n, 2 * STATE), _F)
        trace = []
        for t in range(steps):
            back = steps - 1 - t
            x = np.stack([gates[0][index[t]], gates[1][index[back]]])
            m = np.stack([mask[t], mask[back]])
            u = np.matmul(h, self.p["state"])
            zr = _sigmoid(x[:, :, : 2 * STATE] + u[:, :, : 2 * STATE])
            z, r = zr[:, :, :STATE], zr[:, :, STATE:]
            cand = _tanh(x[:, :, 2 * STATE :] + r * u[:, :, 2 * STATE :])
            new = cand + z * (h - cand)
            if keep is not None:
                trace.append((h, z, r, cand, u[:, :, 2 * STATE :], m))
            h = h + m * (new - h)
            states[t, :, :STATE] = h[0]
            states[back, :, STATE:] = h[1]
        a = _tanh(states @ self.p["attend"])
        e = a @ self.p["query"]
        e = np.where(inside, e, _F(-1e9))
        e -= e.max(axis=0)
        np.exp(e, out=e)
        e *= inside
        weight = e / np.maximum(e.sum(axis=0), _F(1e-9))
        pooled = np.einsum("tn,tnd->nd", weight, states)
        if keep is not None:
            keep |= {"trace": trace, "states": states, "a": a, "weight": weight, "pooled": pooled, "index": index, "steps": steps}
        return pooled @ self.p["out"] + self.p["out_bias"][0]

    def gradients(self, texts: Texts, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy over all windows."""
        number, chars = self._inputs(texts)
        gates, k = self._gates(number, chars), {}
        prob = _sigmoid(self.logits(gates, texts.at, texts.size, k))
        g = {name: np.zeros_like(v) for name, v in self.p.items()}
        d_logit = ((prob - target) / len(target)).astype(_F)
        g["out"], g["out_bias"][0] = k["pooled"].T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weight = np.einsum("tnd,nd->tn", k["states"], d_pooled)
        d_states = k["weight"][:, :, None] * d_pooled
        d_e = k["weight"] * (d_weight - (k["weight"] * d_weight).sum(axis=0))
        g["query"] = np.einsum("tn,tna->a", d_e, k["a"])
        d_a = d_e[:, :, None] * self.p["query"] * (1 - k["a"] ** 2)
        g["attend"] = np.einsum("tnd,tna->da", k["states"], d_a)
        d_states = d_states + d_a @ self.p["attend"].T
        d_h = np.zeros((2, len(target), STATE), _F)
        d_gates = np.zeros_like(gates)
        for t in range(k["steps"] - 1, -1, -1):
            back = k["steps"] - 1 - t
            h, z, r, cand, u, m = k["trace"][t]
            d_h[0] += d_states[t, :, :STATE]
            d_h[1] += d_states[back, :, STATE:]
            d_new = d_h * m
            d_cand = d_new * (1 - z) * (1 - cand**2)
            d_z = d_new * (h - cand) * z * (1 - z)
            d_r = d_cand * u * r * (1 - r)
            d_u = np.concatenate([d_z, d_r, d_cand * r], axis=2)
            d_x = np.concatenate([d_z, d_r, d_cand], axis=2)
            g["state"] += np.matmul(h.transpose(0, 2, 1), d_u)
            d_h = d_h * (1 - m) + d_new * z + np.matmul(d_u, self.p["state"].transpose(0, 2, 1))
            np.add.at(d_gates[0], k["index"][t], d_x[0])
            np.add.at(d_gates[1], k["index"][back], d_x[1])
        length = texts.ends - texts.starts
        for d in range(2):
            own = d_gates[d, :-1]
            g["bias"][d] = own.sum(axis=0)
            into = own @ self.p["in"][d].T
            g["in"][d][:WORD_DIM] = self.p["word"][number].T @ own
            g["in"][d][WORD_DIM:] = chars.T @ own
            np.add.at(g["word"], number, into[:, :WORD_DIM])
            np.add.at(g["char"], texts.bytes, np.repeat(into[:, WORD_DIM:] / length[:, None].astype(_F), length, axis=0))
        return g

    def windows(self, texts: Texts, most: int = 4096) -> np.ndarray:
        """Logit of every window, so many at a time."""
        out = np.empty(len(texts.at), _F)
        for lo in range(0, len(out), most):
            part = texts.between(lo, min(lo + most, len(out)))
            out[lo : lo + most] = self.logits(self._gates(*self._inputs(part)), part.at, part.size)
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each text: that of its worst window."""
        texts = Texts(data, offsets)
        if not len(texts.of):
            return np.zeros(0)
        worst = np.maximum.reduceat(self.windows(texts), texts.first)
        return 1 / (1 + np.exp(-worst.astype(np.float64)))


class Constant:
    """Stands in for the network where there is nothing to learn from."""

    def __init__(self, value: float):
        self.value = value

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.full(len(offsets) - 1, self.value)


def train(texts: list[str], toxic: list[int], seed: int = 5) -> Network | Constant:
    """Network fitted to texts and their labels."""
    target = np.array(toxic, _F)
    if not len(target) or target.min() == target.max():
        return Constant(min(0.49, float(target.mean())) if len(target) else 0.0)
    raw = [t.encode() for t in texts]
    seen = Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    # texts that have a word
    doc = np.repeat(np.arange(len(raw)), np.diff(np.searchsorted(seen.starts, np.cumsum([0, *map(len, raw)]))))
    every, number = np.unique(seen.hashes, return_inverse=True)
    both = np.bincount(np.unique(number * len(raw) + doc) // len(raw), minlength=len(every))
    order = np.lexsort((every, -both))[:VOCABULARY]
    chosen = np.sort(order[both[order] >= max(LEAST_TEXTS, LEAST_SHARE * len(raw))])
    net = Network(every[chosen], seed)
    rng = np.random.default_rng(seed)
    first = {n: np.zeros_like(v) for n, v in net.p.items()}
    second = {n: np.zeros_like(v) for n, v in net.p.items()}
    # before the first epoch all windows are equal, and a text's last one counts
    logit = np.zeros(len(seen.of), _F)
    mean = {n: np.zeros_like(v) for n, v in net.p.items()}
    step = 0
    last = np.append(seen.first[1:], len(seen.of)) - 1
    epoch = 0
    while epoch < LEAST_EPOCHS or step < LEAST_UPDATES:  # a small sample takes more epochs
        epoch += 1
        rank = np.lexsort((logit, seen.of))
        worst = rank[last]
        # of clean texts also the next worst window, and one by chance
        clean = np.flatnonzero(target == 0)
        second_worst = rank[np.maximum(last[clean] - 1, seen.first[clean])]
        chance = seen.first[clean] + rng.integers(0, last[clean] - seen.first[clean] + 1)
        pick = np.concatenate([worst, second_worst, chance])
        rng.shuffle(pick)
        for lo in range(0, len(pick), BATCH):
            part = pick[lo : lo + BATCH]
            g = net.gradients(seen.only(part), target[seen.of[part]])
            step += 1
            for n, v in net.p.items():
                first[n] += 0.1 * (g[n] - first[n])
                second[n] += 0.001 * (g[n] ** 2 - second[n])
                v -= RATE * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8) + RATE * 1e-3 * v
                mean[n] += (1 - AVERAGE) * (v - mean[n])
        logit = net.windows(seen)
    net.p = {n: (v / (1 - AVERAGE**step)).astype(_F) for n, v in mean.items()}
    return net


def allowance(sizes: list[int], most: int) -> int:
    """Characters that each text may give so that all give ``most`` at most."""
    left = most
    for k, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - k)
        if size > share:
            return share
        left -= size
    return max(sizes, default=0)


def pieces(text: Column, size: Column, most: int) -> Column:
    """The text, or pieces of it at even distances, of ``most`` characters in all, if it has more."""
    width = min(PIECE, max(most, 1))
    many = max(1, most // (width + 1))
    starts = F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda k: (k * (size - width) / F.lit(max(many - 1, 1))).cast("int"))
    cut = F.array_join(F.transform(starts, lambda at: F.substring(text, at + 1, F.lit(width))), "\n")
    return F.when(size <= most, text).otherwise(cut)


def sample(docs: DataFrame, labels: DataFrame, train_row: Column, most_toxic: int, most_clean: int, most_characters: int, id_col: str, text_col: str) -> tuple[list[str], list[int]]:
    """Texts and labels to train on, of bounded number and size."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).where(train_row)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn("size", F.length("text"))
    # only ids that have a text count towards the limits; of several texts the smallest counts
    known = known.join(rows.select("id").hint("merge"), "id", "left_semi")
    order = [F.md5(F.col("id").cast("string").cast("binary")), F.col("id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(most_toxic).unionByName(known.where("toxic = 0").orderBy(*order).limit(most_clean))
    ids = [tuple(r) for r in chosen.collect()]  # at most most_toxic + most_clean
    if not ids:
        return [], []
    chosen = docs.sparkSession.createDataFrame(ids, "id long, toxic int")
    rows = rows.join(F.broadcast(chosen), "id")
    # of an id's texts the first by a digest, so that no task holds them all
    named = rows.withColumn("name", F.sha2(F.col("text").cast("binary"), 256))
    sizes = named.groupBy("id").agg(F.min(F.struct("name", "size")).alias("best")).select("id", "best.*").collect()  # a row for each id
    most = allowance([r["size"] for r in sizes], most_characters)
    best = docs.sparkSession.createDataFrame([(r["id"], r["name"]) for r in sizes], "id long, name string")
    taken = named.join(F.broadcast(best), ["id", "name"]).select("id", "toxic", pieces(F.col("text"), F.col("size"), most).alias("text"))
    taken = taken.groupBy("id", "toxic").agg(F.min("text").alias("text")).collect()  # most_characters at most
    taken.sort(key=lambda r: r["id"])
    return [r["text"] for r in taken], [r["toxic"] for r in taken]


def _score(net: Network | Constant):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = string_buffers(batch.column(1))
            for lo, hi in slices(offs, BATCH_BYTES):
                score = net.score(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score, pa.float64())], names=["id", "score"])

    return given_back(run)


def toxicity(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, held_out_of: int = 5, id_col: str = "doc_id", text_col: str = "text", most_characters: int = MOST_CHARACTERS) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    Ids whose crc32 (as text) is a multiple of ``held_out_of`` aren't trained on.
    """
    net = train(*sample(docs, labels, crc32_mod("id", held_out_of) != 0, most_toxic, most_clean, most_characters, id_col, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(_score(net), "id long, score double")
    held_out = crc32_mod("id", held_out_of) == 0
    return scored.select(F.col("id").alias(id_col), held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, held_out_of: int = 5, id_col: str = "doc_id", text_col: str = "text", most_characters: int = MOST_CHARACTERS) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns as they were.

    The score is made beside the row itself, so rows that share an id are judged by their own text.
    """
    net = train(*sample(docs, labels, crc32_mod("id", held_out_of) != 0, most_toxic, most_clean, most_characters, id_col, text_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = string_buffers(batch.column(at))
            for lo, hi in slices(offs, BATCH_BYTES):
                clean = net.score(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]) < 0.5
                yield batch.slice(lo, hi - lo).filter(pa.array(clean))

    return docs.mapInArrow(given_back(run), docs.schema)
