"""URL filter by a bit-parallel wildcard automaton.

All glob rules are packed into the bits of a few 64-bit words, one bit for
each character of a rule.  A step of Shift-And moves every active bit one
place on where the rule's next character is the URL's, for all rules at once;
a star is a bit that stays active.  The step runs over a whole batch of URLs,
the longest first, so a batch costs as many steps as its longest URL has
bytes, and only the URLs that long take part in the last ones.

A URL is matched in its canonical form: a dot, the host (A-Z lower-cased), and
the path.  In a rule, ``*`` stands for any bytes and ``~`` for any bytes of the
host.  Host rules such as ``example.org/es/`` (the host and all subdomains, if
the path starts with the rule's) become ``~.example.org/es/*``; the longest one
that fits decides.  Where none fits, the verdict is the method's: block if any
glob of ``BLOCK_GLOBS`` fits, else allow.

Memory: the states of a batch have as many words as it has URLs times those of
the rules, and are bounded by ``STATE_WORDS`` however many rules there are.

Defined results: a null URL, or one without ``://``, has an empty host and
path, no rule and the method's verdict for an empty URL.  Of several longest
rules the first listed counts.  Repeated rows give repeated rows; an empty table
gives an empty table.  Only the id and URL columns are read, so other columns
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, string_buffers

#: Host rules of the query, as (rule, verdict).
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
#: The method's own rules: advertising and spam hosts, and pages made for machines.
BLOCK_GLOBS = ["~.ads-*", "~.spam-*", "~.doubleclick.net/*", "~.adservice.*", "*/wp-login.php*", "*/cgi-bin/*"]
#: URL bytes of a batch, and words of its URLs' states (or one URL's).
BATCH_BYTES, STATE_WORDS = 4 << 20, 4 << 20


class WildcardAutomaton:
    """Shift-And over several 64-bit words for a list of globs."""

    def __init__(self, globs: list[str]):
        cells: list[tuple[set[int] | None, bool, bool]] = []  # (bytes or any, stays, stays in the host)
        starts, self.accept = [], []
        for glob in globs:
            raw = glob.encode()
            # a start cell of each rule is active before the first byte; stars make the cell before them stay
            starts.append(len(cells))
            cells.append((set(), False, False))  # no byte leads here, so nothing enters from the rule before
            for c in raw:
                if c == 0x2A:
                    cells[-1] = (cells[-1][0], True, False)
                elif c == 0x7E:
                    cells[-1] = (cells[-1][0], cells[-1][1], True)
                else:
                    cells.append(({c}, False, False))
            self.accept.append(len(cells) - 1)
        self.words = max(1, -(-len(cells) // 64))
        self.start = self._bits(starts)
        self.move = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        for i, (own, always, in_host) in enumerate(cells):
            word, bit = divmod(i, 64)
            one = np.uint64(1) << np.uint64(bit)
            for c in own or ():
                self.move[c, word] |= one
            if always:
                self.stay[:, word] |= one
            elif in_host:
                self.stay[:, word] |= one
                self.stay[0x2F, word] &= ~one

    def _bits(self, places: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for i in places:
            out[i // 64] |= np.uint64(1) << np.uint64(i % 64)
        return out

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, globs) booleans: which globs match which whole texts."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        state = np.tile(self.start, (len(order), 1))
        at, ordered = offsets[:-1][order], sizes[order]
        longest = int(ordered[0]) if len(ordered) else 0
        # how many texts have a byte at each place
        active = np.searchsorted(-ordered, -np.arange(longest), side="left") if longest else ()
        one, high = np.uint64(1), np.uint64(63)
        for step in range(longest):
            n = active[step]
            now = state[:n]
            c = data[at[:n] + step]
            shifted = now << one
            shifted[:, 1:] |= now[:, :-1] >> high
            state[:n] = (shifted & self.move[c]) | (now & self.stay[c])
        out = np.empty((len(order), len(self.accept)), bool)
        for k, i in enumerate(self.accept):
            out[order, k] = (state[:, i // 64] >> np.uint64(i % 64)) & one == one
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?`` or ``#``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "#", 1)).otherwise("")
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    host = F.translate(F.substring_index(rest, "/", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.substring(rest, F.length(host) + 1, F.length(rest))


def _judge(rules: list[tuple[str, str]], block: list[str]):
    automaton = WildcardAutomaton([f"~.{rule}*" for rule, _ in rules] + block)
    rows = max(1, STATE_WORDS // max(automaton.words, len(automaton.accept) // 8))
    # from the last to the first choice: shorter rules, and of equal ones the later listed
    by_length = sorted(range(len(rules)), key=lambda i: (len(rules[i][0]), -i))
    names = np.array([None, *(r for r, _ in rules)], object)
    verdicts = np.array(["allow", *(v for _, v in rules)], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = string_buffers(batch.column(3))
            for lo, hi in ((a, min(a + rows, to)) for at, to in slices(offs, BATCH_BYTES) for a in range(at, to, rows)):
                part = data[offs[lo] : offs[hi]]
                found = automaton.matches(part, offs[lo : hi + 1] - offs[lo])
                best = np.zeros(hi - lo, np.int64)
                for i in by_length:
                    best[found[:, i]] = i + 1
                verdict = verdicts[best]
                verdict[(best == 0) & found[:, len(rules) :].any(axis=1)] = "block"
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(3)), pa.array(names[best], pa.string()), pa.array(verdict, pa.string())], names=["id", "host", "path", "rule", "verdict"])

    return run


def url_filter(pages: DataFrame, rules: list[tuple[str, str]] = RULES, block: list[str] = BLOCK_GLOBS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path")).withColumn("canonical", F.concat(F.lit("."), F.col("host"), F.col("path")))
    return rows.mapInArrow(_judge(rules, block), "id long, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
