"""Detection of entities: dictionary phrases, rules, and both together.

A dictionary's phrases are far fewer than a corpus has tokens.  Up to
``MOST_COLLECTED`` of them go to Python, which looks a text through in one pass.
Of more, only tokens that are a word of some phrase go on; those look at as many
of the ones behind them as the longest phrase has, and meet phrases by the first word.  A dictionary of up to
``MOST_BROADCAST`` phrases, which is counted, goes to all executors, so tokens
stay where their document is; a larger one meets them in a shuffle by word.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicons import MEDICATION, MEDICATION_TAIL
from ..functions.similarity import overlaps
from .spans import Block, Span, find_all, in_blocks, in_python, is_plain, refined, resolve_overlaps, resolved, tokens, within_document

#: Phrases that every executor can hold.
MOST_BROADCAST = 1_000_000
#: Phrases that go to Python, where a text is looked through in one pass, and spellings that it remembers.
MOST_COLLECTED, MOST_SPELLINGS = 100_000, 500_000
#: Characters after a phrase that can be taken in.
TAIL_SIZE = 96
#: What tells a document's entities apart.
SPAN = ("start", "end", "type")
#: Columns of a detected entity.
ENTITY = ("document_id", "start", "end", "text", "type", "candidate_id", "confidence", "mention_head", "evidence", "ord")


def phrases(records: DataFrame, most_words: int = 10) -> DataFrame:
    """Dictionary (phrase, words, first, n, type, candidate_id, ord) of records (type, candidate_id, detection_aliases, ord).

    Kept are phrases of at least four characters that aren't a number, of up to
    ``most_words`` words; a single word needs five characters.
    """
    named = records.select("type", "candidate_id", "ord", F.posexplode("detection_aliases").alias("place", "alias")).withColumn("phrase", X.alias_key(F.col("alias")))
    named = named.withColumn("words", F.split("phrase", " ")).withColumn("n", F.size("words"))
    good = (F.length("phrase") >= 4) & ~F.rlike("phrase", F.lit(r"^\p{Nd}+$")) & (F.col("n") <= most_words) & ((F.col("n") > 1) | (F.length("phrase") >= 5))
    first = named.where(good).groupBy("phrase", "words", "n", "type", "candidate_id").agg(F.min(F.struct("ord", "place")).alias("o"))
    order = F.row_number().over(W.partitionBy("phrase").orderBy("o", "type", "candidate_id"))
    return first.select("phrase", "words", F.col("words")[0].alias("first"), "n", "type", "candidate_id", order.alias("ord"))


def _hits(entries: list[tuple[list[str], str, str, int]], most_words: int) -> Callable[[list[str | None]], list[list[tuple]]]:
    """Hits of each text: (start, head, rest, type, candidate_id, ord) of the longest phrase at every token, ``rest`` being what follows it.

    Tokens are numbered by the dictionary's words, all texts' at once; only those
    that are a phrase, or begin with the token behind them like one, are looked at.
    """
    entries = [e for e in entries if len(e[0]) <= most_words]
    number = {w: k for k, w in enumerate(dict.fromkeys(w for words, *_ in entries for w in words))}
    phrases: dict[tuple[int, ...], list[tuple[str, str, int]]] = {}
    sizes: dict[int, set[int]] = {}
    for words, kind, code, place in entries:
        own = tuple(number[w] for w in words)
        phrases.setdefault(own, []).append((kind, code, place))
        sizes.setdefault(own[0], set()).add(len(own))
    longest_first = {w: sorted(n, reverse=True) for w, n in sizes.items()}
    alone = np.array([1 in sizes.get(k, ()) for k in range(len(number))] + [False])  # -1 is no word of the dictionary
    pairs = np.array(sorted({p[0] * len(number) + p[1] for p in phrases if len(p) > 1}), np.int64)
    names = pa.array(number, pa.string())
    seen: dict[str, int] = {}  # spellings and the dictionary's words

    def number_of(spelt: str) -> int:
        try:
            return seen[spelt]
        except KeyError:
            if len(seen) >= MOST_SPELLINGS:
                seen.clear()
            n = seen[spelt] = number.get(X.alias_of(spelt), -1)
            return n

    def of(texts: list[str | None]) -> list[list[tuple]]:
        block = Block(texts)
        words = block.words()
        # of ASCII tokens a word's spellings differ by case alone
        ids = pc.index_in(pc.ascii_lower(words), value_set=names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        other = ~pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
        coded = words.filter(pa.array(other)).dictionary_encode()
        ids[other] = np.array([number_of(w) for w in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
        following = np.append(ids[1:], -1)[: len(ids)]
        begins = alone[ids] | ((ids >= 0) & (following >= 0) & np.isin(ids * len(number) + following, pairs))
        out = [[] for _ in texts]
        for k in np.flatnonzero(begins).tolist():
            at = block.of[k]
            last = block.first[at + 1]
            for n in longest_first[ids[k]]:
                if k + n <= last and (hit := phrases.get(tuple(ids[k : k + n].tolist()))):
                    start, until = int(block.start[k] - block.at[at]), int(block.end[k + n - 1] - block.at[at])
                    text = texts[at]
                    out[at].extend((start, text[start:until], text[until : until + TAIL_SIZE], *e) for e in hit)
                    break
        return out

    return of


def dictionary_hits(docs: DataFrame, dictionary: DataFrame, most_words: int = 10, confidence: float = 0.94, extend: tuple[str, ...] = ("DRUG",), tail: str | None = None) -> DataFrame:
    """Entities of the longest phrase at every token, one for each of its dictionary entries.

    Types of ``extend`` take in the medication attributes that follow.
    """
    entries = dictionary.select("words", "type", "candidate_id", "ord").limit(MOST_COLLECTED + 1).collect()
    kwargs = {} if tail is None else {"tail": tail}
    if len(entries) <= MOST_COLLECTED:
        of = _hits([tuple(e) for e in entries], most_words)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("head", pa.string()), ("rest", pa.string()), ("type", pa.string()), ("candidate_id", pa.string()), ("ord", pa.int32())]))

        def run(texts: pa.Array) -> pa.Array:
            return pa.concat_arrays([pa.array([], kind), *(pa.array(of(block), kind) for _, block in in_blocks(texts.to_pylist()))])

        found = F.arrow_udf(run, "array<struct<start: int, head: string, rest: string, type: string, candidate_id: string, ord: int>>")
        hits = docs.select("document_id", found("raw_text").alias("found_")).select("document_id", F.inline("found_"))
        more = F.when(F.col("type").isin(*extend), X.extended_end(F.col("rest"), F.lit(0), TAIL_SIZE, **kwargs)).otherwise(F.lit(0)) if extend else F.lit(0)
        text = F.concat("head", F.substring("rest", F.lit(1), F.col("more_")))
        return hits.withColumn("more_", more).select(
            "document_id", "start", (F.col("start") + F.length("head") + F.col("more_")).cast("int").alias("end"), text.alias("text"), "type", "candidate_id",
            F.lit(confidence).alias("confidence"), F.col("head").alias("mention_head"), F.lit("ontology_exact_phrase").alias("evidence"), "ord",
        )
    rows = tokens(docs).withColumn("norm", X.normalize_alias(F.col("text")))
    known = dictionary.select(F.explode("words").alias("norm")).distinct()
    size, longest = dictionary.agg(F.count(F.lit(1)), F.max("n")).first()
    most_words = max(1, min(most_words, longest or 1))
    if size <= MOST_BROADCAST:  # its words are at most most_words times as many
        dictionary, known = F.broadcast(dictionary), F.broadcast(known)
    order = within_document().orderBy("i")
    # a token whose place isn't the next one ends what can be a phrase
    word = F.struct("i", "norm", "end")
    rows = rows.join(known, "norm", "left_semi").select("document_id", "i", "start", "norm", F.col("end").alias("end0"), *(F.lead(word, k).over(order).alias(f"w{k}") for k in range(1, most_words)))
    rows = rows.select("document_id", "i", "start", "norm", "end0", *(F.when(F.col(f"w{k}.i") == F.col("i") + k, F.col(f"w{k}.{c}")).alias(f"{c}{k}") for k in range(1, most_words) for c in ("norm", "end")))
    met = rows.join(dictionary, rows["norm"] == dictionary["first"])
    following = F.array("norm", *(f"norm{k}" for k in range(1, most_words)))
    met = met.where(F.slice(following, 1, F.col("n")) == F.col("words")).withColumn("until", F.array(*(f"end{k}" for k in range(most_words)))[F.col("n") - 1])
    longest = F.max("n").over(W.partitionBy("document_id", "i"))
    met = met.withColumn("longest", longest).where("n = longest")
    hits = met.select("document_id", "start", "until", "type", "candidate_id", "ord")
    whole = hits.join(docs.select("document_id", "raw_text"), "document_id")
    end = F.when(F.col("type").isin(*extend), X.extended_end(F.col("raw_text"), F.col("until"), **kwargs)).otherwise(F.col("until")) if extend else F.col("until")
    whole = whole.withColumn("end", end.cast("int"))
    return whole.select(
        "document_id", "start", "end", X.piece(F.col("raw_text"), F.col("start"), F.col("end")).alias("text"), "type", "candidate_id",
        F.lit(confidence).alias("confidence"), X.piece(F.col("raw_text"), F.col("start"), F.col("until")).alias("mention_head"), F.lit("ontology_exact_phrase").alias("evidence"), "ord",
    )


def rule_hits(docs: DataFrame, rules: list[tuple[str, str, str | None]], confidence: float = 0.78) -> DataFrame:
    """Entities of the rules (type, pattern, pattern of the head in the match)."""
    out = None
    for at, (kind, pattern, head) in enumerate(rules):
        found = find_all(docs, pattern).select(
            "document_id", "start", "end", "text", F.lit(kind).alias("type"), F.lit(None).cast("string").alias("candidate_id"), F.lit(confidence).alias("confidence"),
            (F.regexp_extract("text", head, 0) if head else F.col("text")).alias("mention_head"), F.lit(f"rule_{kind.lower()}").alias("evidence"), F.lit(1_000_000 + at).alias("ord"),
        )
        out = found if out is None else out.unionByName(found)
    return out


def without_symptoms(hits: DataFrame, rule_found: DataFrame, less: str = "DISEASE", more: str = "SYMPTOM") -> DataFrame:
    """Dictionary hits without those of one type that say the same as an overlapping rule hit of the other."""
    a = hits.withColumn("norm_", X.alias_key(F.col("text")))
    b = rule_found.where(F.col("type") == more).select(F.col("document_id").alias("d_"), F.col("start").alias("s_"), F.col("end").alias("e_"), X.alias_key(F.col("text")).alias("n_"))
    same = (F.col("document_id") == F.col("d_")) & (F.col("norm_") == F.col("n_")) & overlaps(F.col("start"), F.col("end"), F.col("s_"), F.col("e_")) & (F.col("type") == less)
    return a.join(b, same, "left_anti").drop("norm_")


def detect(docs: DataFrame, dictionary: DataFrame, rules: list[tuple[str, str, str | None]], **options) -> DataFrame:
    """Dictionary hits, without diseases that a symptom rule finds too, and rule hits; overlaps resolved."""
    by_rule = rule_hits(docs, rules)
    by_phrase = without_symptoms(dictionary_hits(docs, dictionary, **options), by_rule)
    return resolve_overlaps(by_phrase.unionByName(by_rule))


def _plainly(pattern: str) -> re.Pattern | None:
    """A plain pattern, which may be bound to the beginning, as Python has it."""
    bound = pattern.startswith("^")
    plain = in_python(pattern.removeprefix("^"))
    return None if plain is None else re.compile(("^" if bound else "") + plain)


def _alias_of(text: str) -> str:
    return text.lower().strip(" ") if text.isascii() and text.replace(" ", "").isalnum() and "  " not in text else X.alias_of(text)


def _alternatives(plain: str) -> list[tuple[str, str]]:
    """Alternatives of a plain pattern, each with letters in a row that all its matches have."""
    out, runs, run, begin, i = [], [], "", 0, 0
    while i <= len(plain):
        c = plain[i : i + 1]
        if c in ("", "|"):
            out.append((plain[begin:i], max([*runs, run], key=len)))
            runs, run, begin = [], "", i + 1
        elif c in "[(":
            runs, run, depth = [*runs, run], "", 0
            while True:
                if plain[i] == "[":
                    i = plain.index("]", i)
                elif plain[i] == "\\":
                    i += 1
                depth += (plain[i] == "(" and plain[i - 1] != "\\") - (plain[i] == ")" and plain[i - 1] != "\\")
                if depth == 0:
                    break
                i += 1
        elif c in "*?{":
            # the letter before it can be left out
            runs, run = [*runs, run[:-1]], ""
            i = plain.index("}", i) if c == "{" else i
        elif c == "+":
            runs, run = [*runs, run], ""
        else:
            i += c == "\\"
            run += plain[i]
        i += 1
    return out


def _finder(pattern: str) -> Callable[[str], Iterable[re.Match]] | None:
    """Matches of a plain pattern in a text: alternatives are left out where letters that they need don't occur."""
    if (whole := _plainly(pattern)) is None:
        return None
    parts = _alternatives(pattern) if is_plain(pattern) else [(whole.pattern, "")]
    needed = [n for _, n in parts]
    made: dict[tuple[bool, ...], Callable[[str], Iterable[re.Match]]] = {(True,) * len(parts): whole.finditer, (False,) * len(parts): lambda text: ()}

    def find(text: str) -> Iterable[re.Match]:
        here = tuple(n in text for n in needed)
        if here not in made:
            made[here] = re.compile("|".join(p for (p, _), at in zip(parts, here, strict=True) if at)).finditer
        return made[here](text)

    return find


def entities_at_once(docs: DataFrame, dictionary: DataFrame, rules: list[tuple[str, str, str | None]], most_words: int = 10, confidence: float = 0.94, rule_confidence: float = 0.78, extend: tuple[str, ...] = ("DRUG",), tail: str | None = None, less: str = "DISEASE", more: str = "SYMPTOM") -> DataFrame | None:
    """``detect`` and ``refine_boundaries`` of whole documents: a text is looked through, and its spans are chosen, in one pass.

    None if a pattern may mean something else in Python, or the dictionary has more than ``MOST_COLLECTED`` phrases.
    """
    own = [(kind, _finder(pattern), head and _plainly(head), bool(head), f"rule_{kind.lower()}") for kind, pattern, head in rules]
    after = _plainly(MEDICATION_TAIL if tail is None else tail)
    if after is None or any(found is None or (has_head and head is None) for _, found, head, has_head, _ in own):
        return None
    entries = dictionary.select("words", "type", "candidate_id", "ord").limit(MOST_COLLECTED + 1).collect()
    if len(entries) > MOST_COLLECTED:
        return None
    hits_of = _hits([tuple(e) for e in entries], most_words)

    def found_in(text: str, hits: list[tuple]) -> list[Span]:
        by_rule, same = [], {}  # names of the one type's rule spans, and their bounds
        for at, (kind, find, head, _, evidence) in enumerate(own):
            for m in find(text):
                said = m.group()
                mention = said if head is None else h.group() if (h := head.search(said)) else ""
                by_rule.append((*m.span(), said, kind, None, rule_confidence, mention, evidence, 1_000_000 + at))
                if kind == more:
                    same.setdefault(_alias_of(said), []).append(m.span())
        # the furthest end of the spans up to each
        for name, spans in same.items():
            spans.sort()
            same[name] = ([s for s, _ in spans], list(accumulate((e for _, e in spans), max)))
        out = []
        for start, head, rest, kind, code, place in hits:
            said = head
            if kind in extend and (m := after.search(rest.split("\n", 1)[0])):
                said = head + rest[: len(m.group())]
            end = start + len(said)
            if kind == less and same and (near := same.get(_alias_of(said))) and (i := bisect_left(near[0], end)) and near[1][i - 1] > start:
                continue
            out.append((start, end, said, kind, code, confidence, head, "ontology_exact_phrase", place))
        return refined(resolved(out + by_rule))

    kind = docs.schema["document_id"].dataType.simpleString()
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.string(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in in_blocks(batch.column(1).to_pylist()):
                of, rows = [], []
                for i, (text, hits) in enumerate(zip(texts, hits_of(texts), strict=True), lo):
                    spans = found_in(text, hits) if text else []
                    of.extend([i] * len(spans))
                    rows.extend(spans)
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), *columns], list(ENTITY))

    return docs.select("document_id", "raw_text").mapInArrow(run, f"document_id {kind}, start int, end int, text string, type string, candidate_id string, confidence double, mention_head string, evidence string, ord int")


def annotate(entities: DataFrame, docs: DataFrame, found_sections: DataFrame, cues: dict[str, str], prefix: int = 55, width: int = 120) -> DataFrame:
    """Entities with their section and the four axes of assertion."""
    from .spans import with_section

    rows = with_section(entities, found_sections).join(docs.select("document_id", "raw_text"), "document_id")
    text, start, end = F.col("raw_text"), F.col("start"), F.col("end")
    axes = X.axes(X.prefix(text, start, prefix), X.context(text, start, end, width), F.col("section_name"), cues)
    return rows.withColumns({k: c for k, c in axes.items()}).drop("raw_text")


def _near(placed: DataFrame, on: list[str], most: int) -> DataFrame:
    """Ordered pairs of spans (start, end, type) with equal ``on``, ``most`` characters apart at most, with their ``distance``."""
    from ..functions.similarity import gap
    from .spans import meeting

    def side(name: str) -> DataFrame:
        return placed.select(*on, *(F.col(c).alias(f"{name}_{c}") for c in SPAN))

    a = side("subject").withColumns({"a_start": F.col("subject_start") - most, "a_end": F.col("subject_end") + most + 1})
    b = side("object").withColumns({"b_start": F.col("object_start"), "b_end": F.col("object_end") + 1})
    both = meeting(a, b, on, max(most, 64)).withColumn("distance", gap(*(F.col(c) for c in ("subject_start", "subject_end", "object_start", "object_end"))))
    return both.where(F.col("distance") <= most)


def relation_examples(entities: DataFrame, gold: DataFrame, most: int = 256) -> DataFrame:
    """Pairs of a document's entities as training rows: ``label`` is the gold relation, or NO_RELATION.

    Entities are told apart by start, end and type; repeated ones count once.
    ``gold`` has document_id, subject_start, subject_end, subject_type, the same
    of the object, and relation; of several relations of a pair the last in
    order counts.
    """
    pair = ["document_id", *(f"{side}_{c}" for side in ("subject", "object") for c in SPAN)]
    both = _near(entities.select("document_id", *SPAN).distinct(), ["document_id"], most)
    same = F.lit(True)
    for c in SPAN:
        same = same & (F.col(f"subject_{c}") == F.col(f"object_{c}"))
    known = gold.groupBy(*pair).agg(F.max("relation").alias("label"))
    return both.where(~same).join(known, pair, "left").select(*pair, F.coalesce("label", F.lit("NO_RELATION")).alias("label"), "distance")


#: Order of a document's relations: by subject, object and relation.
RELATION_ORDER = ("document_id", "subject_start", "subject_end", "subject_type", "object_start", "object_end", "object_type", "relation")


def relations(entities: DataFrame, found_sentences: DataFrame, compatible: dict[tuple[str, str], str], most: int = 256) -> DataFrame:
    """Pairs of entities in one sentence whose types go together, with a confidence that falls with their distance.

    Only entities within ``most`` characters meet, however long a sentence is.
    """
    from .spans import with_sentence

    placed = with_sentence(entities.select("document_id", "start", "end", "type"), found_sentences).where("sentence_id IS NOT NULL")
    pairs = X.mapping({f"{s}>{o}": r for (s, o), r in compatible.items()})
    both = _near(placed, ["document_id", "sentence_id"], most)
    both = both.withColumn("relation", F.try_element_at(pairs, F.concat("subject_type", F.lit(">"), "object_type"))).where("relation IS NOT NULL")
    confidence = F.round(F.greatest(F.lit(0.5), F.lit(0.88) - F.col("distance") / F.lit(float(max(most, 1))) * 0.25), 6)
    return both.select("document_id", "sentence_id", "subject_start", "subject_end", "subject_type", "object_start", "object_end", "object_type", "relation", "distance", confidence.alias("confidence"))


def medication(entities: DataFrame, column: Column | str = "text", patterns: dict[str, str] = MEDICATION) -> DataFrame:
    """Entities with the medication attributes of their text."""
    col = F.col(column) if isinstance(column, str) else column
    return entities.withColumn("attributes", X.medication_attributes(col, patterns))
