"""BPE encoding and decoding by per-prefix dynamic programming.

For each prefix of a word exactly one token can be the last one of the
prefix's encoding.  All tokens that are suffixes of the prefix come from an
automaton of the vocabulary (a trie with suffix links, from pyahocorasick,
which lists all tokens that end at a place); a token is the last one if the prefix
before it ends in a token with which it is compatible, that is if no merge of
lower rank would have joined anything across their border.  Back-pointers from
the whole word give the exact ids, in time linear in the word's length and
without replaying merges.

The vocabulary file is a parameter (a path that every executor can open, of a
BPE model with word ends, as the tokenizers library stores it).  Only the text
steps before the merges are the library's in texts beyond Latin letters, where
they depend on its version of Unicode; they are: special tokens are cut out first; NFC; white space runs to one
space; lower case; split into words by the file's pattern; UTF-8 bytes as
printable characters.  Decoding joins the tokens of the ids by a space, since
the file has no decoder.

Defined results: a null text is the empty text, with no ids; repeated rows
give repeated rows; an empty table gives an empty table.  Only the id and text
columns are read, so other columns may have any name.  Memory: one Arrow
batch, one text's words, and a cache that is emptied at ``CACHE_WORDS`` words
in each Python worker.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import given_back

#: The caches are emptied after the text that takes them above these numbers.
CACHE_WORDS, CACHE_PAIRS = 150_000, 150_000
WORD_END = "</w>"


def byte_characters() -> list[str]:
    """Printable character of each byte: itself where printable in Latin-1, else the next free one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class PrefixEncoder:
    """Encodes single words (already split and lower-cased) by the vocabulary's merges."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]]):
        self.tokens = {i: t for t, i in vocab.items()}
        self.joined: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.joined[left, right] = whole
            self.rank.setdefault(whole, rank)
            self.parts.setdefault(whole, (left, right))
        # the last character of a word is a symbol of its own: it is marked by a shift into a private range
        self.mark = 0xF0000
        self.automaton = ahocorasick.Automaton()
        self.alone: dict[int, bool] = {}
        for token, i in vocab.items():
            word = token[: -len(WORD_END)] if token.endswith(WORD_END) and len(token) > len(WORD_END) else None
            key = word[:-1] + chr(ord(word[-1]) + self.mark) if word else token
            self.automaton.add_word(key, (i, len(key)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps the border between these two tokens when it encodes their concatenation.

        Undoes the merges of both sides from the latest to the first; at each
        point, the tokens at the border must not have a merge that would have
        come before the one just undone.
        """
        key = (left, right)
        never = 1 << 60
        undone, from_left, ok = never, False, True
        while True:
            whole = self.joined.get((left, right))
            if whole is not None:
                # of equal merges the leftmost comes first: one across the border loses only against its left side
                rank = self.rank[whole]
                if rank < undone or (rank == undone and not from_left):
                    ok = False
                    break
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                break
            # the later merge is undone first; of equal ones the right side's was later
            if a > b:
                undone, from_left, left = a, True, self.parts[left][1]
            else:
                undone, from_left, right = b, False, self.parts[right][0]
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[key] = ok
        return ok

    def whole(self, token: int) -> bool:
        """Whether BPE encodes the token's own text as this one token."""
        known = self.alone.get(token)
        if known is None:
            parts = self.parts.get(token)
            known = parts is None or self.whole(parts[0]) and self.whole(parts[1]) and self._meets(*parts)
            self.alone[token] = known
        return known

    def _meets(self, left: int, right: int) -> bool:
        """Whether both halves of a merge stand when it is its turn: nothing across their border came before."""
        limit = self.rank[self.joined[left, right]]
        undone, from_left = limit, False
        while True:
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                undone, from_left, left = a, True, self.parts[left][1]
            else:
                undone, from_left, right = b, False, self.parts[right][0]
            whole = self.joined.get((left, right))
            if whole is not None:
                rank = self.rank[whole]
                if rank < undone or (rank == undone and not from_left):
                    return False

    def encode(self, word: str) -> list[int]:
        """Ids of a word of byte characters."""
        marked = word[:-1] + chr(ord(word[-1]) + self.mark)
        # last token of each prefix, and where the prefix before it ends
        last, back, known = [-1] * len(word), [0] * len(word), self.pairs
        for end, (token, size) in self.automaton.iter(marked):
            if last[end] < 0:
                start = end - size
                if start < 0:
                    fits = self.whole(token)
                else:
                    left = last[start]
                    fits = known.get((left, token))
                    if fits is None:
                        fits = left >= 0 and self.compatible(left, token)
                if fits:
                    last[end], back[end] = token, start
        ids, at = [], len(word) - 1
        while at >= 0:
            ids.append(last[at])
            at = back[at]
        ids.reverse()
        return ids


class TextEncoder:
    """Whole texts to ids and back, with the text steps of the vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("end_of_word_suffix") != WORD_END or spec.get("decoder") is not None or spec.get("post_processor") is not None:
            raise ValueError(f"{path}: not a vocabulary with word ends and without a decoder")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.words = PrefixEncoder(model["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = self.words.tokens | {i: t for t, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find: Callable[[str], list[str]] = regex.compile(self.split).findall
        self.cache = WordCache(self.words)
        self.library = Tokenizer.from_str(json.dumps({k: v for k, v in spec.items() if k != "model"} | {"model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self.rare = regex.compile(r"[^\x00-\u024F]").search

    def pieces(self, text: str) -> Iterator[tuple[str, str]]:
        """(ids, tokens), each joined by a space, of the runs between special tokens and of these."""
        for k, part in enumerate(self.cut.split(text) if self.cut and "<" in text else [text]):
            if k % 2:
                yield str(self.special[part]), part
            elif part and not part.isascii() and self.rare(part):
                # where letters and case depend on the version of Unicode, the library splits by its own
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)):
                    yield self.cache.encode(word)
            elif part:
                words = self.find(unicodedata.normalize("NFC", part).lower())
                if words:
                    # one run of C calls for all words; the cache encodes those it hasn't
                    yield " ".join(map(self.cache.__getitem__, words)), " ".join(map(self.cache.tokens.__getitem__, words))
                    self.cache.trim()

    def rest(self) -> None:
        """Empties the caches: the worker that holds them may not be asked again."""
        self.cache.clear()
        self.cache.tokens.clear()
        self.words.pairs.clear()

    def joined(self, text: str) -> tuple[str, str]:
        """Ids and tokens of a whole text, each joined by a space."""
        pieces = list(self.pieces(text))
        return " ".join([ids for ids, _ in pieces]), " ".join([tokens for _, tokens in pieces])

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.joined(text)[0].split()))

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


class WordCache(dict):
    """Ids, joined by a space, of each word; looking up a missing word encodes it.  ``tokens`` has its tokens."""

    def __init__(self, words: PrefixEncoder):
        super().__init__()
        self.words, self.bytes, self.tokens = words, byte_characters(), {}

    def encode(self, characters: str) -> tuple[str, str]:
        ids, names = self.words.encode(characters), self.words.tokens
        return " ".join(map(str, ids)), " ".join([names[i] for i in ids])

    def __missing__(self, word: str) -> str:
        ids, tokens = self.encode("".join([self.bytes[b] for b in word.encode()]))
        self[word], self.tokens[word] = ids, tokens
        return ids

    def trim(self) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()
            self.tokens.clear()


_LOADED: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The encoder of a path, loaded once in a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = TextEncoder(path)
    return _LOADED[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                ids = [enc.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return given_back(run)


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [enc.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return given_back(run)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for cell in batch.column(1):
                ids, decoded = enc.joined(cell.as_py() or "")
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            made = [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *batch.columns[2:]], names=["id", "n_tokens", "ids_sha256", "decoded_sha256", *batch.schema.names[2:]])
        enc.rest()

    return given_back(run)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encode(path), "id long, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the decoded text of each list of ids; special tokens are kept."""
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decode(path), "id long, text string").withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the decoded text, made in one pass.

    Columns of ``keep`` come along beside them.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)))
    kinds = "".join(f", keep{i} {dict(rows.dtypes)[f'keep{i}']}" for i in range(len(keep)))
    made = rows.mapInArrow(_digests(path), f"id long, n_tokens long, ids_sha256 string, decoded_sha256 string{kinds}")
    return made.select(F.col("id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256", *(F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)))
