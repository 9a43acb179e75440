"""Toxicity, sharding, mixing, language model, licenses and the pipeline against brute force."""

import math
import random
import re
import sys
import tracemalloc
import weakref
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glosswerk.llm import common
from glosswerk.llm import hilbert_shards as H
from glosswerk.llm import license_scan as C
from glosswerk.llm import maxent_lm as L
from glosswerk.llm import mixing as X
from glosswerk.llm import queries as Q
from glosswerk.llm import toxicity as T
from glosswerk.llm.license_texts import LICENSES

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def corpus(n=400, seed=1, toxic=0.25):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("th", "er", "on", "an", "re", "he", "in", "ed") for b in ("a", "en", "or", "ti", "es", "is", "al", "ou")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 200))]
        bad = rng.random() < toxic
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "Scum!", "moron,"]))
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), f"src{rng.randint(0, 9)}", 0))
        labels.append((i, int(bad)))
    return rows, labels


# toxicity


def test_gradients_are_differences():
    rng = np.random.default_rng(2)
    raw = [b"ab cd ef gh", b"x", b"", b"ab ab cd"]
    texts = T.Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    net = T.Network(np.unique(texts.hashes)[:3], 1)
    net.p = {k: (rng.standard_normal(v.shape) * 0.5).astype(np.float32) for k, v in net.p.items()}
    target = np.array([1, 0, 1, 0], np.float32)
    part = texts.only(np.arange(4))
    g = net.gradients(part, target)

    def loss():
        z = net.windows(part).astype(np.float64)
        return np.mean(np.logaddexp(0, z) - target * z)

    for name, value in net.p.items():
        flat = value.reshape(-1)
        at = [i for i in rng.permutation(flat.size) if name not in ("char", "word") or abs(g[name].reshape(-1)[i]) > 1e-5][:4]
        for i in at:
            old, step = flat[i], 1e-2
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert (up - down) / (2 * step) == pytest.approx(g[name].reshape(-1)[i], abs=2e-3), name


def test_windows_cover_every_word():
    raw = [b" ".join(b"w%d" % i for i in range(n)) for n in (0, 1, 31, 32, 33, 48, 49, 200)]
    t = T.Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    seen = np.zeros(len(t.starts), int)
    for a, s in zip(t.at, t.size):
        seen[a : a + s] += 1
    assert seen.min() >= 1 and set(t.of) == set(range(8)) and t.size.max() == T.WINDOW


def test_toxicity_on_held_out_rows(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], DOCUMENTS + ", score double")
    extra = [(None, 1), (0, None), (10_000, 1)]
    got = {r["doc_id"]: r for r in T.toxicity(docs, spark.createDataFrame(labels + extra, "doc_id long, toxic int")).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == set(held) and len(held) > 40
    truth = dict(labels)
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    kept = T.drop_toxic(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}


def test_toxicity_other_cases(spark):
    rows = [(1, None, "a", "b", 0), (2, "", "a", "b", 0), (None, "x", "a", "b", 0), (1, None, "a", "b", 0), (4, "long " * 60_000, "a", "b", 0)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r["score"], r["predicted"]) for r in T.toxicity(docs, none).collect()} == {(0.0, 0)}
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert {r["predicted"] for r in T.toxicity(docs, labels).collect()} == {0}
    assert T.toxicity(docs.limit(0), none).collect() == [] and T.drop_toxic(docs, none).count() == 5
    net = T.train(["you idiot", "fine words here"] * 10, [1, 0] * 10)
    scores = net.score(np.frombuffer(b"idiot" + b"fine words", np.uint8), np.array([0, 0, 5, 15]))
    assert len(scores) == 3 and scores[1] > 0.5 > scores[2] and scores[0] < 0.5


# sharding


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims).astype(np.uint64)
        index = H.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(index)].astype(int)
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark):
    rng = random.Random(3)
    rows = [(i, "same" if i % 3 else "t" * rng.randint(0, 500), rng.choice(["en", None, "de"]), f"s{i % 5}", None) for i in range(1000)] + [(5000, None, "x", "y", 1), (5000, None, "x", "y", 1), (None, "é", None, None, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCUMENTS + ", shard int, curve int")
    got = H.hilbert_shards(docs, 24).collect()
    assert Counter(str(r["doc_id"]) for r in got) == Counter(str(r[0]) for r in rows)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(24):
        own = sorted((r["slot"], r["curve"]) for r in got if r["shard"] == s)
        assert [a for a, _ in own] == list(range(len(own))) and [c for _, c in own] == sorted(c for _, c in own)
    assert all(max(r["curve"] for r in got if r["shard"] == s) <= min(r["curve"] for r in got if r["shard"] == s + 1) for s in range(23))
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in got)
    few = H.hilbert_shards(docs.limit(3), 24).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert H.hilbert_shards(docs.limit(0), 24).collect() == []
    with pytest.raises(ValueError):
        H.hilbert_shards(docs, 0)


# mixing


def mixed(spark, rows, **options):
    return {r["doc_id"]: r for r in X.mix_sources(spark.createDataFrame(rows, DOCUMENTS), F.substring("source", 1, 1), **options).collect()}


def test_mixing_is_its_sql(spark):
    rows, _ = corpus(300)
    rows += [(1000, None, None, None, None), (1001, "", "en", "src1", 0), (1002, "w " * 5000, "en", "src1", 0)]
    # null and repeated ids, and repeated rows
    rows += [(None, f"n {i % 40}", "en", "src1", 0) for i in range(120)] + [(7, f"seven {i}", "fr", "src2", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = X.mix_sources(docs, Q.source_domain(), Q.MIX_PERCENT, Q.MIX_EPOCHS, Q.MIX_WEIGHTS, Q.MIX_SEED).collect()
    documents = docs.toArrow()  # noqa: F841  read by the SQL
    want = duckdb.sql(Q.mixing_sql().replace("documents", "documents")).fetchall()
    names = [d[0] for d in duckdb.sql(Q.mixing_sql()).description]
    assert sorted([tuple(r[n] for n in names) for r in got], key=str) == sorted(want, key=str)


def test_budgets_go_to_siblings_first(spark):
    words = lambda n: " ".join(["w"] * n)
    rows = [(i, words(10), "en", "a1", 0) for i in range(10)] + [(100 + i, words(10), "en", "a2", 0) for i in range(1000)] + [(2000 + i, words(10), "en", "b1", 0) for i in range(1000)]
    got = mixed(spark, rows, percent=20, epochs=1)
    share = {r["source"]: r["leaf_share"] for r in got.values()}
    # domains get 2010 each; a1 holds 100 only, and its sibling a2 takes the rest
    assert share == {"a1": 100, "a2": 1910, "b1": 2010}
    taken = Counter()
    for r in got.values():
        taken[r["source"]] += r["copies"] * r["n_tokens"]
    assert taken == {"a1": 100, "a2": 1910, "b1": 2010}
    heavy = mixed(spark, rows, percent=20, epochs=1, weights={("a",): 3, ("b", "en", "b1"): 0})
    assert {r["source"]: r["leaf_share"] for r in heavy.values()} == {"a1": 100, "a2": 3920, "b1": 0}


def test_epochs_repeat_and_seeds_differ(spark):
    rows = [(i, "a b c d", "en", "s1", 0) for i in range(100)]
    twice = mixed(spark, rows, percent=150, epochs=2)
    assert Counter(r["copies"] for r in twice.values()) == {1: 50, 2: 50}
    assert {r["copies"] for r in mixed(spark, rows, percent=500, epochs=2).values()} == {2}
    a, b, c = (sorted(i for i, r in mixed(spark, rows, percent=30, epochs=1, seed=s).items() if r["copies"]) for s in (1, 2, 1))
    assert a == c != b and len(a) == 30


def test_mixing_other_cases(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 0, "x", 1)] * 2 + [(None, None, None, None, None, "x", 1)], DOCUMENTS + ", domain string, copies int")
    got = X.mix_sources(docs, F.lit("d"), 100, 1).collect()
    assert sorted((str(r["doc_id"]), r["copies"]) for r in got) == [("1", 1), ("1", 1), ("None", 0)]
    kept = X.drop_unmixed(docs, F.lit("d"), 100)
    # what is left has no tokens, so it isn't within a share of 0
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1, 1]
    # rows of one id, or of none, are judged one by one
    mixed = spark.createDataFrame([(None if i % 2 else 5, f"a b c{i}", "en", "s", 0) for i in range(60)], DOCUMENTS)
    assert 20 <= X.drop_unmixed(mixed, F.lit("d"), 50).count() <= 30
    assert X.mix_sources(docs.limit(0), F.lit("d")).collect() == []
    with pytest.raises(ValueError):
        X.budgets(docs, F.lit(1), 1, {("a",): -1})


def test_scores_are_a_plain_forward_pass():
    """The network's score against a loop over words, one window after the other."""
    rng = np.random.default_rng(3)
    raw = [b" ".join(b"w%d" % rng.integers(0, 9) for _ in range(n)) for n in (0, 1, 5, 24, 25, 60)]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    net = T.Network(np.unique(T.Texts(data, offs).hashes)[:5], 1)
    p = net.p = {k: (rng.standard_normal(v.shape) * 0.5).astype(np.float32) for k, v in net.p.items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def window(words):
        if not words:
            return float(p["out_bias"][0])
        hashes = T.Texts(np.frombuffer(b" ".join(words), np.uint8), np.array([0, len(b" ".join(words))])).hashes
        known = {int(h): i + 1 for i, h in enumerate(net.known)}
        inputs = [np.concatenate([p["word"][known.get(int(h), 0)], np.mean([p["char"][c] for c in w], axis=0)]) for h, w in zip(hashes, words)]
        states = [None] * 2
        for d in range(2):
            h, out = np.zeros(T.STATE), []
            for x in inputs if d == 0 else inputs[::-1]:
                g, u = x @ p["in"][d] + p["bias"][d], h @ p["state"][d]
                z, r, c = (slice(i * T.STATE, (i + 1) * T.STATE) for i in range(3))
                z, new = sigmoid(g[z] + u[z]), np.tanh(g[c] + sigmoid(g[r] + u[r]) * u[c])
                h = z * h + (1 - z) * new
                out.append(h)
            states[d] = out if d == 0 else out[::-1]
        both = np.concatenate(states, axis=1)
        e = np.exp(np.tanh(both @ p["attend"]) @ p["query"])
        return float((e / e.sum()) @ both @ p["out"] + p["out_bias"][0])

    for text, score in zip(raw, net.score(data, offs), strict=True):
        w = text.split()
        starts = [min(k * T.STRIDE, max(len(w) - T.WINDOW, 0)) for k in range(max(0, -(-(len(w) - T.WINDOW) // T.STRIDE)) + 1)]
        assert score == pytest.approx(max(sigmoid(window(w[a : a + T.WINDOW])) for a in starts), abs=1e-4)


def test_sample_leaves_no_row_out_for_its_length(spark):
    assert T.allowance([], 10) == 0 and T.allowance([3, 4], 10) == 4 and T.allowance([1, 100, 50], 21) == 10
    texts = [(i, f"a{i} " * (9_000 if i < 6 else 5)) for i in range(12)] + [(3, "another"), (40, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got, toxic = T.sample(docs, labels, F.lit(True), 800, 2400, 40_000, "doc_id", "text")
    assert (sum(toxic), len(toxic)) == (6, 13) and sum(map(len, got)) <= 40_000 and sum(map(len, got)) > 25_000
    whole, _ = T.sample(docs, labels, F.lit(True), 800, 2400, 1 << 20, "doc_id", "text")
    assert set(whole) <= {t or "" for _, t in texts} and len(T.sample(docs, labels, F.lit(True), 2, 3, 1 << 20, "doc_id", "text")[0]) == 5


def test_long_texts_are_told_apart(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "s", "th", "nd")]
    rows = []
    for i in range(200):
        words = [rng.choice(vocabulary) for _ in range(5200)]
        if i % 2:
            for _ in range(8):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))
        rows.append((i, " ".join(words)))
    assert min(len(t) for _, t in rows) > 20_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = T.toxicity(docs, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")).where("held_out").collect()
    assert len(got) > 25 and np.mean([r["predicted"] == r["doc_id"] % 2 for r in got]) > 0.9


# language model


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(FOLD)) + [None]


def test_language_model(spark):
    rows, _ = corpus(300, seed=4)
    rows += [(900, None, None, None, None), (901, "", "", "", 0), (901, "", "", "", 0), (None, "unseen words\x1chere", "", "", 0), (902, "Thoutside zzz", "", "", 0)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], DOCUMENTS + ", score double")
    got = L.lm_scores(docs).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(w for i, t, *_ in rows if not held(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        own = tokens(texts[r["doc_id"]])
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), len(own), sum(counts[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert L.lm_scores(docs.limit(0)).collect() == []
    none = L.lm_scores(docs.limit(3), train_row=F.lit(False)).collect()
    assert {(r["base_score"], r["train_tokens"], r["n_known"]) for r in none} == {(0.0, 0, 0)}


def head_of(t, sizes=L.Sizes()):
    h, at, n = np.unique(t.hash, return_index=True, return_counts=True)
    order = np.lexsort((h, -n))
    top, rest = order[: sizes.frequent], order[sizes.frequent :]
    tokens, words = np.zeros((L.RARE_CLASSES, sizes.class_words)), np.zeros((L.RARE_CLASSES, sizes.class_words))
    place = t.rare[at][rest], L.bucket(h[rest], sizes.class_words)
    np.add.at(tokens, place, n[rest])
    np.add.at(words, place, 1)
    return L.Head(h[top], n[top], len(t.hash), len(h), tokens, words, sizes)


def test_scores_do_not_depend_on_partitions(spark):
    rows, _ = corpus(300, seed=6)
    docs = spark.createDataFrame(rows, DOCUMENTS)
    a, b = ({r["doc_id"]: (r["score"], r["base_score"]) for r in L.lm_scores(d).collect()} for d in (docs.coalesce(1), docs.repartition(7, "text")))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], rel=1e-6) for i in a)


def test_shards_are_averaged(spark, monkeypatch):
    """Several training shards and shards of parts, in several steps of adding up."""
    rows, _ = corpus(300, seed=6)
    docs = spark.createDataFrame(rows, DOCUMENTS)
    one = {r["doc_id"]: (r["score"], r["base_score"], r["n_known"]) for r in L.lm_scores(docs, F.lit(True)).collect()}
    for name, value in (("TRAIN_TOKENS", 8000), ("FAN", 2), ("EVENTS", 500), ("PART_WORDS", 1), ("CLASS_WORDS", 4), ("FREQUENT_CLASSES", 4)):
        monkeypatch.setattr(L, name, value)
    monkeypatch.setattr(L, "sizes_for", lambda *_: L.Sizes(4, 4))
    few = {r["doc_id"]: (r["score"], r["base_score"], r["n_known"]) for r in L.lm_scores(docs, F.lit(True)).collect()}
    assert all(few[i][1:] == pytest.approx(one[i][1:]) for i in one)
    assert sum(v[0] for v in few.values()) < 0 and sum(v[0] for v in few.values()) > 1.2 * sum(v[1] for v in one.values())


def test_upper_levels_are_brute_force():
    """The model's probabilities, feature by feature, after updates of one small batch."""
    raw = [b"a b c a b d", b"b a b", b"", b"c c a"]
    t = L.Tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    head = head_of(t, L.Sizes(2, 2))
    model = L.Trainer(head)
    c = L.Context(t, head)
    model.update(c)
    z = head.sizes
    for i, logs in enumerate(model.log_probability(c)):
        def symbol(k, i=i):
            j = i - k
            if t.place[i] < k:
                return z.symbols - 1
            rank = {int(h): r for r, h in zip(head.rank, head.hash)}.get(int(t.hash[j]))
            return z.frequent + int(t.rare[j]) if rank is None else rank

        s1, s2, s3 = symbol(1), symbol(2), symbol(3)
        pair = int(L.mix(np.array([s1 * z.symbols + s2], np.uint64))[0]) % 2**64 >> (64 - int(math.log2(z.hashed)))
        x = sum(model.tables[0][r].astype(float) for r in (0, 1 + s1, 1 + z.symbols + s2, 1 + 2 * z.symbols + s3, 1 + 3 * z.symbols + pair)) + model.no_class
        cls, word = int(c.cls[i]), int(c.word[i])
        y = sum(model.tables[1][r].astype(float) for r in (cls, z.classes * (1 + s1) + cls, z.classes * (1 + z.symbols + s2) + cls)) + model.no_word[cls]
        want = x[cls] - np.log(np.exp(x).sum()) + y[word] - np.log(np.exp(y).sum())
        assert logs == pytest.approx(want, abs=1e-4)


def test_model_sums_to_one_and_learns():
    rng = random.Random(7)
    raw = []
    for _ in range(300):
        a = rng.choice([["red", "blue", "green"], ["uno", "dos", "tres"]])
        raw.append(" ".join(rng.choice(a) + ("" if rng.random() < 0.9 else str(rng.randint(0, 99))) for _ in range(30)).encode())
    t = L.Tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    head = head_of(t)
    model = L.Trainer(head)
    c = L.Context(t, head)
    before = model.log_probability(c).mean()
    for _ in range(5):
        model.update(c)
    assert model.log_probability(c).mean() > before + 0.3
    p = model.classes(c.class_rows[:, :50])
    q = model.words(c.word_rows[:, c.is_frequent][:, :50])
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5) and np.allclose(q.sum(axis=1), 1, atol=1e-5)


def test_context_is_the_words_before():
    raw = [b"a b c d", b"", b"a"]
    t = L.Tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert t.first.tolist() == [0, 5, 6, 8] and t.place.tolist() == [0, 1, 2, 3, 4, 0, 0, 1]
    assert [int(x) == int(L.END) for x in t.hash] == [False] * 4 + [True, True, False, True]
    for sizes in (L.Sizes(), L.Sizes(40, 20)):
        rows, start = L.Context(t, head_of(t, sizes)).class_rows, sizes.symbols - 1
        assert [rows[1][i] == 1 + start for i in range(8)] == [True, False, False, False, False, True, True, False]
        assert [rows[2][i] == 1 + sizes.symbols + start for i in range(8)] == [True, True, False, False, False, True, True, True]


def test_rare_words_have_contexts(spark):
    rng = random.Random(3)
    pairs = [(f"a{i}xx", f"b{i}xx") for i in range(1500)]
    filler = [f"f{i}" for i in range(600)]
    rows = [(i, " ".join(w for _ in range(25) for w in (*rng.choice(pairs), *rng.choices(filler, k=4)))) for i in range(900)]
    some = rng.sample(pairs, 200)
    # the same words, all of them rare and with the same last bytes, after their own and after other words
    rows += [(1000, " ".join(w for p in some for w in p)), (1001, " ".join(w for p, q in zip(some, some[1:] + some[:1], strict=True) for w in (p[0], q[1])))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in L.lm_scores(docs.repartition(2, "doc_id"), train_row=F.col("id") < 1000).where("doc_id >= 1000").collect()}
    assert got[1000] > got[1001] + 20


def test_sizes_follow_the_counts():
    assert L.sizes_for(0, 0) == L.sizes_for(1000, 1000) == L.Sizes()
    small, large = L.sizes_for(2_000_000, 40_000_000), L.sizes_for(200_000_000, 40_000_000_000)
    assert large.frequent > 2 * small.frequent > 2 * L.FREQUENT and large.hashed > 5 * small.hashed > 5 * L.HASHED
    vast = L.sizes_for(10**9, 10**12)
    assert 4 * (vast.word_rows * vast.class_words + vast.class_rows * vast.classes) < 1 << 30


@pytest.mark.parametrize("least", [1, 2])
def test_part_probabilities_are_brute_force(monkeypatch, least):
    monkeypatch.setattr(L, "LEAST_SEEN", least)
    rng = np.random.default_rng(1)
    n = 400
    leaf, word = rng.integers(0, 3, n), rng.integers(1, 9, n).astype(np.uint64)
    one, two = (rng.integers(1, 6, n).astype(np.uint32) for _ in range(2))
    learn = rng.random(n) < 0.8
    logs, count = L.part_scores(leaf, word, one, two, learn)
    counts = [Counter(word[learn & (leaf == p)].tolist()) for p in range(3)]
    assert count.tolist() == [counts[p][w] for p, w in zip(leaf, word.tolist())]
    path, bias = {}, [{}, {}]
    for p, c in enumerate(counts):
        ranked = [*sorted(c, key=lambda w: (-c[w], w)), None]
        wide = math.ceil(math.sqrt(len(ranked)))
        for r, w in enumerate(ranked):
            path[p, w] = ((p,), r // wide), ((p, r // wide), r % wide)
            for b, (node, place) in zip(bias, path[p, w]):
                b.setdefault(node, {}).setdefault(place, 0)
                b[node][place] += 1 + c.get(w, 0)
    both = (L.mix((one.astype(np.uint64) << np.uint64(24)) | two) >> np.uint64(40)).astype(np.uint32)
    steps = [path.get((p, w), path[p, None]) for p, w in zip(leaf.tolist(), word.tolist())]
    want = np.log([sum(bias[0][p,].values()) for p in leaf.tolist()])
    for level in range(2):
        # one batch: the gradients of all tokens with a feature, at weights of 0
        seen = [Counter((steps[i][level][0], x[i]) for i in range(n) if learn[i]) for x in (one, both)]
        feature = lambda i, k: (steps[i][level][0], (one, both)[k][i])  # noqa: E731, B023
        share = lambda node: {d: m / sum(bias[level][node].values()) for d, m in bias[level][node].items()}  # noqa: E731, B023
        grads = [{}, {}]
        for i in range(n):
            node, place = steps[i][level]
            active = [k for k in range(2) if seen[k][feature(i, k)] >= L.LEAST_SEEN]
            if learn[i]:
                for k in active:
                    g = grads[k].setdefault(feature(i, k), Counter())
                    for d, q in share(node).items():
                        g[d] += q - (d == place)
        wide = max(max(b) + 1 for lv in bias for b in lv.values())
        for i in range(n):
            node, place = steps[i][level]
            x = {d: math.log(m) for d, m in bias[level][node].items()}
            for k in range(2):
                g = grads[k].get(feature(i, k))
                if g:
                    size = 0.1 + sum(v * v for v in g.values()) / wide
                    for d in x:
                        x[d] -= L.PART_RATE * g[d] / math.sqrt(size)
            want[i] += x[place] - math.log(sum(math.exp(v) for v in x.values()))
    assert logs == pytest.approx(want, abs=1e-4)


def test_part_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    word, one, two = rng.integers(1, 9, 400).astype(np.uint64), *(rng.integers(1, 9, 400).astype(np.uint32) for _ in range(2))
    # each known word and an unknown one after the same two words
    asked, same = np.arange(1, 10, dtype=np.uint64), np.full(9, 3, np.uint32)
    logs, _ = L.part_scores(np.zeros(409, int), np.append(word, asked), np.append(one, same), np.append(two, same), np.arange(409) < 400)
    assert np.exp(logs[400:]).sum() == pytest.approx(400 + 8 + 1, rel=1e-4)


def test_counts_hold_less_than_their_tokens(monkeypatch):
    monkeypatch.setattr(L, "BATCH_BYTES", 1 << 18)
    rng = np.random.default_rng(1)
    text = " ".join(f"w{i}" for i in rng.integers(0, 20_000, 1_400_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text[i : i + 5000] for i in range(0, len(text), 5000)])], names=["text"])
    list(L._count(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    got = list(L._count(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = Counter(w for t in batch.column(0).to_pylist() for w in [*t.split(), "end"])
    assert sorted(r["n"] for b in got for r in b.to_pylist() if r["rare"] >= 0) == sorted(want.values())
    assert peak < 30 * 1_400_000


def test_one_level_of_parts_at_a_time_and_memory_goes_back(monkeypatch):
    alive, most = weakref.WeakSet(), []

    class Level(L.Level):
        def __init__(self, *args):
            most.append(len(alive))
            super().__init__(*args)
            alive.add(self)

    monkeypatch.setattr(L, "Level", Level)
    rng = np.random.default_rng(1)
    word, (one, two) = rng.integers(1, 9, 400).astype(np.uint64), rng.integers(1, 6, (2, 400)).astype(np.uint32)
    L.part_scores(rng.integers(0, 3, 400), word, one, two, rng.random(400) < 0.8)
    assert most == [0, 0]

    given = []
    monkeypatch.setattr(common, "_give_back", lambda: given.append(1))
    none = np.zeros((L.RARE_CLASSES, L.CLASS_WORDS))
    head = L.Head(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0, none, none)
    L._train(head)((pa.scalar(0),), pa.table({"digest": [1], "text": ["a b"]}))
    L._score_parts(head)((pa.scalar(-1),), pa.table({"key": [-1]}))
    rows = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([7]), pa.array([True]), pa.array(["a b"])], names=["row", "id", "learn", "text"])
    assert len(list(L._emit(head, L.Model(head), 1)(iter([rows])))) == 2
    assert len(given) == 3


# licenses


def test_licenses(spark):
    mit = LICENSES["MIT"]
    variant = "Copyright (c) 2024 Someone\n\n" + mit.upper().replace("\n", "\r\n").replace(",", " ,") + "\n(C) 2020 Other.\nAll rights reserved.\n"
    spelled = mit.replace("sublicense", "sub-licence").replace("copyright holders", "copyright owners").replace("COPYRIGHT HOLDERS", "COPYRIGHT OWNERS")
    rows = [(i, t) for i, t in enumerate([*LICENSES.values()])] + [(100, variant), (101, spelled), (102, mit + " and more"), (103, None), (104, ""), (105, "Copyright 2020 X"), (105, "Copyright 2020 X"), (None, mit), (106, "é" * 100_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license_id string")
    got = C.license_scan(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["license_id"] for r in got}
    assert [by[i] for i in range(len(LICENSES))] == list(LICENSES)
    assert (by[100], by[101], by[None]) == ("MIT", "MIT", "MIT")
    assert [by[i] for i in (102, 103, 104, 105, 106)] == [None] * 5
    own = spark.createDataFrame([("b", "My terms."), ("a", "my TERMS"), ("c", "Copyright 1999 Z")], "license_id string, text string")
    assert {r["license_id"] for r in C.license_scan(spark.createDataFrame([(1, "* My terms *"), (2, "")], "doc_id long, text string"), own).collect()} == {"a", None}
    assert C.license_scan(docs.limit(0)).collect() == []


def test_query_finds_planted_licenses(spark, tmp_path):
    """op10 and its SQL over a table with licenses, their copies in other dress, and near misses."""
    whole = {p.stem: p.read_text() for p in (Path(C.__file__).parent / "licenses").glob("*.txt")}
    mit = LICENSES["MIT"]
    curly = mit.replace('"', "\u201c").replace("-", "\u2013").replace(", ", "\u00a0\u2014 ")
    texts = [mit, curly, "\u00a9 2024 Some One\n\n" + mit, "\ufeff* " + mit.replace("\n", "\n * "), whole["Apache-2.0"], whole["GPL-3.0"].upper(), whole["MPL-2.0"].replace("\n", "\r\n")]
    wrong = [mit + "x", mit.replace("software", "hardware"), whole["GPL-3.0"][:-200], "Released under the MIT License.", "", None, "\u00a9 2024 Some One", "Straße \u0130 licensed"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts + wrong)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in Q.op10_license_scan(spark, str(tmp_path)).collect()}
    want = ["MIT"] * 4 + ["Apache-2.0", "GPL-3.0", "MPL-2.0"] + [None] * len(wrong)
    assert [got[i]["license_id"] for i in range(len(rows))] == want
    documents = spark.read.parquet(str(tmp_path / "documents.parquet")).toPandas()  # noqa: F841  read by the SQL
    theirs = {r[0]: r for r in duckdb.sql(Q.ORACLE_SQL["op10_license_scan"]).fetchall()}
    assert {i: theirs[i][3] for i in theirs} == dict(enumerate(want))
    assert [theirs[i][1:3] for i in range(len(rows) - 1)] == [(got[i]["n_canonical"], got[i]["canonical_sha256"]) for i in range(len(rows) - 1)]
    own = C.read_licenses(spark, str(Path(C.__file__).parent / "licenses"))
    assert {r["license_id"] for r in C.license_scan(spark.createDataFrame(rows[:7], DOCUMENTS), own).collect()} == {None, "Apache-2.0", "GPL-3.0", "MPL-2.0"}


def test_whole_licenses_and_titles(spark):
    folder = Path(C.__file__).parent / "licenses"
    whole = {p.stem: p.read_text() for p in folder.glob("*.txt")}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= set(whole)
    asked = [*whole.items()]
    asked += [(i, whole[i].upper().replace("\n", "\r\n")) for i in ("GPL-3.0", "MPL-2.0")]
    asked += [("Apache-2.0", whole["Apache-2.0"].split("APPENDIX")[0]), ("Apache-2.0", whole["Apache-2.0"].split("licenses/", 1)[1])]
    asked += [("GPL-2.0", re.sub("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301", "59 Temple Place, Suite 330, Boston, MA  02111-1307", whole["GPL-2.0"]))]
    mine = "\n\nCopyright (c) 2024 Someone\n\n"
    titles = {"0BSD": "BSD Zero Clause License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "The 3-Clause BSD License", "ISC": "ISC License (ISC)", "Unlicense": "The Unlicense", "Zlib": "zlib License"}
    asked += [(i, t + mine + LICENSES[i]) for i, t in titles.items()]
    asked += [("MIT (with its name)", "The MIT License (MIT)" + mine + LICENSES["MIT"]), (None, "Their License" + mine + LICENSES["MIT"]), (None, whole["GPL-2.0"][:9000])]
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(asked)], "doc_id long, text string")
    got = {r["doc_id"]: r["license_id"] for r in C.license_scan(docs).collect()}
    assert [got[n] for n in range(len(asked))] == [i for i, _ in asked]


# pipeline


def test_pipeline(spark, tmp_path):
    rows, labels = corpus(150, seed=8)
    clean = [i for i, t in labels if not t]
    rows.append((500, rows[clean[0]][1], "en", "src1", 0))  # an exact copy
    long = next(i for i in clean if len(rows[i][1].split()) > 150)
    rows.append((501, rows[long][1] + " more", "en", "src1", 0))  # a near copy
    rows += [(502, "", "en", "src1", 0), (503, None, None, None, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DOCUMENTS + ", kept int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    left, at = {}, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        left[name] = {r["doc_id"] for r in at.select("doc_id").collect()}
    toxic = {i for i, t in labels if t}
    assert len(left["toxicity"] & toxic) <= 2 and len(set(clean) - left["toxicity"]) <= 2
    assert left["toxicity"] - left["exact_dedup"] == {500, 503}
    assert left["exact_dedup"] - left["near_dedup"] == {501}
    assert left["mixing"] < left["near_dedup"] and left["tokens"] == left["mixing"]
    assert at.count() == corpus_pipeline.run(spark, str(tmp_path)).count()
