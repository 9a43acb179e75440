"""BPE against the tokenizers library, transport streams by round trips, and URL rules by brute force."""

import fnmatch
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from glosswerk.llm import bpe as B
from glosswerk.llm import transport_stream as T
from glosswerk.llm import url_filter as U

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    ranges = [(32, 127)] * 6 + [(0, 0x300)] * 2 + [(0x300, 0x2FFF), (0x3000, 0xD7FF), (0xE000, 0xFFFF), (0x10000, 0x1FFFF)]
    some = ["aaaaaa", "ababab", "the", "''''", "!!!!", "<|endoftext|>", "<|startoftext|>", "Σ", "İ", "ß", "\x1c", "\x85", "é", "é"]
    made = ["".join(chr(rng.randint(*rng.choice(ranges))) if rng.random() < 0.6 else rng.choice(some) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    return made + ["".join(rng.choice("aabeinsth") for _ in range(rng.randint(1, 25))) for _ in range(1500)] + ["", " ", "x" * 20_000, "it's we'll I'd"]


def test_bpe_is_the_library(library):
    enc = B.encoder(PATH)
    for t in texts():
        ids = library.encode(t, add_special_tokens=False).ids
        assert enc.encode(t) == ids
        assert enc.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_with_a_small_cache(library, monkeypatch):
    monkeypatch.setattr(B, "CACHE_WORDS", 3)
    monkeypatch.setattr(B, "CACHE_PAIRS", 3)
    enc = B.TextEncoder(PATH)
    for t in ("the quick brown fox jumps", "over the lazy dogs again"):
        assert enc.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_bpe_tables(spark, library):
    rows = [(1, "Hello hello"), (1, "Hello hello"), (None, "x"), (2, None), (3, "")]
    docs = spark.createDataFrame([(*r, 9, "z") for r in rows], "doc_id long, text string, ids int, id string")
    coded = B.bpe_encode(docs, PATH)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in coded.collect()) == sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    assert sorted(r["text"] for r in B.bpe_decode(coded, PATH).collect()) == sorted(library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, t in rows)
    got = B.bpe_digests(docs, PATH, keep=("ids",)).collect()
    ids = library.encode("Hello hello", add_special_tokens=False).ids
    row = [r for r in got if r["doc_id"] == 1][0]
    assert (row["n_tokens"], row["ids_sha256"], row["ids"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), 9)
    empty = [r for r in got if r["doc_id"] == 2][0]
    assert (empty["n_tokens"], empty["ids_sha256"]) == (0, hashlib.sha256(b"").hexdigest())
    assert B.bpe_digests(docs.limit(0), PATH).collect() == []


SIZES = [0, 1, 63, 64, 65, 155, 156, 157, 160, 168, 169, 352, 353, 16_383, 16_384, 16_385, 70_000, 300_000]


@pytest.mark.parametrize("size", SIZES)
def test_stream_round_trip(size):
    payload = np.random.default_rng(size).integers(0, 256, size).astype(np.uint8)
    stream = T.mux(payload)
    assert len(stream) % T.PACKET == 0 and stream[:: T.PACKET] == b"\x47" * (len(stream) // T.PACKET)
    got = T.demux(stream)
    units = max(1, -(-size // T.UNIT_BYTES))
    assert got["payload"] == payload.tobytes() and got["fault"] is None and got["continuity_errors"] == 0
    assert got["units"] == units and got["last_pts"] == (units - 1) * T.UNIT_TICKS
    assert [p[0] for p in got["points"]] == [u * T.UNIT_TICKS for u in range(0, units, T.RANDOM_ACCESS_EVERY)]
    assert all(p[2] == u * T.UNIT_BYTES for p, u in zip(got["points"], range(0, units, T.RANDOM_ACCESS_EVERY)))
    assert got["programs"] == {1: {"pid": T.PMT_PID, "streams": {T.MEDIA_PID: T.STREAM_TYPE}}}


def test_damaged_streams():
    payload = np.arange(40_000, dtype=np.uint64).astype(np.uint8)
    stream = T.mux(payload)
    packets = [stream[i : i + T.PACKET] for i in range(0, len(stream), T.PACKET)]
    lost = T.demux(b"".join(packets[:10] + packets[11:]))
    assert lost["continuity_errors"] == 1 and len(lost["payload"]) < len(payload)
    twice = T.demux(b"".join(packets[:10] + packets[9:]))
    assert twice["continuity_errors"] == 0 and twice["payload"] == payload.tobytes()
    assert T.demux(stream[:-5])["fault"] == "the last packet is cut"
    assert T.demux(b"\0" * 188)["fault"] == "a packet without its sync byte"
    assert T.demux(b"")["fault"] == "no program" and T.demux(b"")["payload"] == b""
    bad_crc = bytearray(packets[0])
    bad_crc[14] ^= 1
    assert T.demux(bytes(bad_crc) + b"".join(packets[1:]))["fault"] == "no program"


def test_section_crc():
    assert T.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_media_tables(spark):
    rows = [(1, "abc"), (2, "abc"), (3, None), (4, ""), (5, "é" * 40_000), (None, "x"), (1, "abc")]
    docs = spark.createDataFrame([(*r, 1, "m") for r in rows], "doc_id long, text string, n_bytes int, media string")
    media = T.store(docs)
    got = T.media_features(media).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i, t in rows:
        raw = (t or "").encode()
        padded = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        r = by[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert r["media_sha256"] == hashlib.sha256(T.mux(np.frombuffer(padded, np.uint8))).hexdigest()
    assert by[1]["feature"] == by[2]["feature"]
    back = {r["doc_id"]: r for r in T.read_back(media).collect()}
    assert bytes(back[5]["payload"]) == ("é" * 40_000).encode() and back[5]["units"] == 5 and len(back[5]["points"]) == 2
    null = T.read_back(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first()
    assert null["fault"] == "no program" and bytes(null["payload"]) == b""
    assert T.media_features(T.store(docs.limit(0))).collect() == []


def test_automaton_is_glob_matching():
    rng = random.Random(6)
    globs = ["".join(rng.choice("ab/.**") for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["*", "a" * 70, "*" + "ab" * 40 + "*"]
    urls = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 14))) for _ in range(400)] + ["a" * 70, "x" + "ab" * 40, ""]
    data = np.frombuffer("".join(urls).encode(), np.uint8)
    offs = np.cumsum([0, *map(len, urls)])
    got = U.WildcardAutomaton(globs).matches(data, offs)
    for i, u in enumerate(urls):
        for k, g in enumerate(globs):
            assert got[i, k] == bool(re.fullmatch(fnmatch.translate(g.replace("[", "[[]")), u)), (u, g)


def test_url_rules(spark):
    cases = [
        ("https://Example.ORG/es/1?q#f", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://a.example.org/en/2", "a.example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("http://x.com/fr", "x.com", "/fr", None, "allow"),
        ("http://x.com?u=http://a.org/", "x.com", "", None, "allow"),
        ("http://evil.net/a.org/x", "evil.net", "/a.org/x", None, "allow"),
        ("http://x.net/cgi-bin/a", "x.net", "/cgi-bin/a", None, "block"),
        ("http://www.ads-track.net/", "www.ads-track.net", "/", None, "block"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("a://org", "org", "", None, "allow"),
        ("a://x://y/z", "x:", "//y/z", None, "allow"),
        ("http://x.com/fr/" + "y" * 100_000, "x.com", "/fr/" + "y" * 100_000, "com/fr/", "allow"),
    ]
    rows = [(i, c[0], "h", "r") for i, c in enumerate(cases)] + [(0, cases[0][0], "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = U.url_filter(pages).orderBy("page_id").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == cases[r["page_id"]][1:], cases[r["page_id"]]
    assert U.url_filter(pages.limit(0)).collect() == []
    assert U.url_filter(pages.withColumn("page_id", F.lit(None).cast("long"))).count() == len(rows)


def test_short_program_map_and_signalled_break(spark):
    import numpy as np

    from glosswerk.llm import transport_stream as V

    stream = bytearray(V.mux(np.arange(V.PAD * 40, dtype=np.uint8)))
    assert V.demux(bytes(stream))["fault"] is None
    short = V._table_packet(V.PMT_PID, V._section(2, V.PROGRAM, b"\xe1\x00"))
    got = V.demux(bytes(stream[: V.PACKET]) + short + bytes(stream[2 * V.PACKET :]))
    assert got["fault"] == "a program map without its length" and got["payload"] == b""
    whole = V.mux(np.zeros(V.UNIT_BYTES * 2, np.uint8))
    at = 2 * V.PACKET + whole[2 * V.PACKET :].index(b"\x47\x41", 1)  # the second unit's first packet
    broken = bytearray(whole)
    broken[at + 3] = broken[at + 3] & 0xF0 | (broken[at + 3] + 5) & 15
    errors = V.demux(bytes(broken))["continuity_errors"]
    broken[at + 5] |= 0x80
    assert V.demux(bytes(broken))["continuity_errors"] == errors - 1


def test_many_rules_in_small_batches(spark, monkeypatch):
    from glosswerk.llm import url_filter as U

    rules = [(f"h{i}.org/", "block") for i in range(200)]
    rows = [(i, f"http://a.h{i % 300}.org/x") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    monkeypatch.setattr(U, "STATE_WORDS", 300)
    got = {r["page_id"]: r["verdict"] for r in U.url_filter(pages, rules, []).collect()}
    assert got == {i: "block" if i % 300 < 200 else "allow" for i, _ in rows}
