"""Exact dedup, near-duplicate groups and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from glosswerk.llm import exact_dedup as E
from glosswerk.llm import minhash as M
from glosswerk.llm import textscan as S
from glosswerk.llm.common import string_buffers
from glosswerk.llm.components import connected_components

FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
CLASH = "doc_id long, text string, keep_id string, kept string, grp int, node int, id int, n int, body int, digit int"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, 2, 3, 4, 5, 6) for r in rows], CLASH)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(FOLD))


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def exact(rows):
    body = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(body(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[body(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(body(t).encode()).hexdigest()))
    return sorted(out, key=str)


def exact_rows():
    rng = random.Random(1)
    base = ["x" * 70, "x" * 64, "x" * 65, "x" * 5000 + "a", "x" * 5000 + "b", "y" * 64 + "é" * 3000, "a  b\n", "a b ", "", None, " ", "\t\n", "q" * 300_000]
    rows = [(i, rng.choice(base)) for i in range(120)]
    return rows + [(7, "same"), (7, "same"), (7, "other"), (8, "same"), (None, "same"), (None, "lonely"), (None, "lonely")]


def test_exact_dedup_is_brute_force(spark):
    rows = exact_rows()
    got = E.exact_dedup(frame(spark, rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == exact(rows)


def test_unequal_texts_of_shared_and_null_ids_stay(spark):
    a, b, x, y = "a" * 64, "b" * 64, "x" * 100, "y" * 100
    rows = [(1, a + x), (2, a + y), (1, b + y), (3, b + x)]
    assert sorted([tuple(r) for r in E.exact_dedup(frame(spark, rows)).collect()], key=str) == exact(rows)
    assert E.drop_copies(frame(spark, rows)).count() == 4
    rows = [(None, h + t) for h in (a, b) for t in (x, y)]
    assert {r["group_size"] for r in E.exact_dedup(frame(spark, rows)).collect()} == {1} and E.drop_copies(frame(spark, rows)).count() == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_dedup_of_heads_and_tails(spark, seed):
    """Texts of equal length from a few heads, middles and tails, which part in every round, under few ids."""
    rng = random.Random(seed)
    heads = ["".join(rng.choice("ab") for _ in range(64)) for _ in range(3)]
    middles = ["".join(rng.choice("cd") for _ in range(64 * 64)) for _ in range(2)]
    tails = ["".join(rng.choice("ef") for _ in range(n)) for n in (1, 36, 36)] + [""]
    rows = []
    for _ in range(160):
        text = rng.choice(heads) + rng.choice(["", *middles, *(m + rng.choice(tails) for m in middles)]) + rng.choice(tails)
        rows.append((rng.choice([None, 1, 2, 3, 4]), text))
    assert sorted([tuple(r) for r in E.exact_dedup(frame(spark, rows)).collect()], key=str) == exact(rows)
    body = {}
    for i, t in rows:
        if i is not None:
            body[t] = min(i, body.get(t, i))
    kept = sorted(((i, t) for i, t in rows if i == body.get(t)), key=str)
    assert sorted(map(tuple, E.drop_copies(frame(spark, rows)).collect()), key=str) == kept


def test_exact_dedup_other_cases(spark):
    assert E.exact_dedup(frame(spark, [])).collect() == []
    rows = [(2, "a"), (1, "a"), (3, None)]
    assert sorted([tuple(r) for r in E.exact_dedup(clashing(spark, rows)).collect()], key=str) == exact(rows)
    kept = E.drop_copies(clashing(spark, rows))
    assert kept.columns == clashing(spark, rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_words_are_the_regular_expression(spark):
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["".join(rng.choice(" \t\x0b\nab\u00e9\u3000\x1c\x85Z") for _ in range(rng.randint(0, 40))) for _ in range(200)] + [None, "w" * (S.SEGMENT + 5), "ab " * S.SEGMENT]
    data, offs = string_buffers(pa.array(texts, pa.string()))
    data = S.LOWER[data]
    starts, ends, hashes, first = S.words(data, offs)
    seen = {}
    for i, t in enumerate(texts):
        own = [bytes(data[a:b]) for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert own == words(t)
        for w, h in zip(own, hashes[first[i] : first[i + 1]].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def brute(rows, k, percent):
    rows = [(i, t, shingle_set(t, k)) for i, t in rows]
    parent = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, _, s in rows:
        for b, _, t in rows:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, _, s in rows}


def near_rows(seed, groups=12, copies=9):
    """Groups of near copies around the threshold, in chains, with exact copies among them."""
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(400)]
    for _ in range(groups):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        for _ in range(copies):
            if rng.random() < 0.8:
                for _ in range(rng.randint(0, 3)):
                    text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text) if rng.random() < 0.7 else "\n".join(text).upper())
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_are_brute_force(spark, k, percent):
    rows = near_rows(k) + [(1000, ""), (1001, None), (1002, "a b"), (1003, "A\tB"), (1004, "a"), (None, "a b"), (1005, "a b a b a b a b"), (1006, "a b a b a b")]
    got = M.near_duplicates(frame(spark, rows), k, percent).collect()
    assert {tuple(r) for r in got} == brute(rows, k, percent)
    assert len(got) == len(rows)


def test_large_bucket_is_finished_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "STRAYS", 4)
    monkeypatch.setattr(M, "MEMBERS", 6)
    rows = near_rows(9, groups=2, copies=60)
    assert {tuple(r) for r in M.near_duplicates(frame(spark, rows), 3, 85).collect()} == brute(rows, 3, 85)


def test_near_duplicates_other_cases(spark):
    assert M.near_duplicates(frame(spark, [])).collect() == []
    rows = [(3, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (5, None)]
    got = M.near_duplicates(clashing(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == [(2, 2, 2, True), (2, 2, 2, True), (3, 2, 2, False), (5, 0, 5, True)]
    kept = M.drop_near_duplicates(clashing(spark, rows))
    assert kept.columns == clashing(spark, rows).columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 2, 5]


def test_rows_are_judged_by_their_own_text(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    near = a + " more"
    kept = lambda rows: sorted(map(tuple, M.drop_near_duplicates(frame(spark, rows)).collect()), key=str)
    assert kept([(1, a), (5, a), (5, b)]) == [(1, a), (5, b)]
    assert len(kept([(5, a), (5, near), (6, b), (6, b), (None, a), (None, b), (7, ""), (7, "")])) == 7
    long = " ".join(f"c{i}" for i in range(3000))
    assert kept([(2, long), (3, long + " x"), (2, b)]) == sorted([(2, b), (2, long)], key=str)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    other = np.concatenate([a[:1800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    bands = 64
    sig = M.signatures(np.concatenate([np.sort(a), np.sort(other)]), np.array([0, 2000, 4000]), bands)
    true = 1800 / 2200
    n = sig.shape[1] // 2
    assert abs((sig[0, :n] == sig[1, :n]).mean() - true) < 0.12 and abs((sig[0, n:] == sig[1, n:]).mean() - true) < 0.12


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (101, 100), (102, 100)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
