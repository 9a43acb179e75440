"""DuckDB SQL of the queries, put together from named common table expressions."""

from __future__ import annotations

from ..functions import lexicons as L
from ..functions import text as X
from . import setting as Q

NEED: dict[str, tuple[str, tuple[str, ...]]] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm(text: str) -> str:
    return f"trim(regexp_replace(replace(lower(nfc_normalize({text})), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' ')"


def piece(text: str, start: str, end: str) -> str:
    return f"substring({text}, ({start}) + 1, greatest(({end}) - ({start}), 0))"


def define(name: str, body: str, *needs: str) -> None:
    NEED[name] = (body, needs)


def sql(final: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEED[name][1]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    head = ",\n".join(f"{n} AS ({NEED[n][0]})" for n in order)
    return (f"WITH RECURSIVE {head}\n" if order else "") + final


def found(pattern: str, docs: str = "docs") -> str:
    """All matches of a pattern with their offsets."""
    p = quoted(pattern)
    return f"""
  SELECT document_id, i::INTEGER AS i, m AS text, (e - length(m))::INTEGER AS start, e::INTEGER AS "end"
  FROM (SELECT *, sum(length(m) + length(g)) OVER (PARTITION BY document_id ORDER BY i) AS e
        FROM (SELECT document_id, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g
              FROM (SELECT document_id, regexp_extract_all(raw_text, {p}) AS ms, string_split_regex(raw_text, {p}) AS gs FROM {docs})))"""


def trimmed(source: str, left: str, right: str, keep: str) -> str:
    return f"""
  SELECT {keep}, substring(text, a + 1, length(text) - a - b) AS text, (start + a)::INTEGER AS start, ("end" - b)::INTEGER AS "end"
  FROM (SELECT *, length(regexp_extract(text, {quoted('^' + left + '*')})) AS a, length(regexp_extract(text, {quoted(right + '*$')})) AS b FROM {source})
  WHERE a < length(text)"""


define("docs", "SELECT doc_id::VARCHAR AS document_id, coalesce(text, '') AS raw_text FROM documents")
define("tok", f"SELECT *, {norm('text')} AS norm FROM ({found(X.TOKEN)})", "docs")
SPACE = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
define("sent", f"SELECT document_id, i AS sentence_id, text, start, \"end\" FROM ({trimmed('(' + found('[^.!?;' + chr(10) + ']+[.!?;]*') + ')', SPACE, SPACE, 'document_id, i')})", "docs")
define("said", "SELECT conv_id || '/' || turn AS document_id, coalesce(text, '') AS raw_text FROM conversations")
define("talk", f"SELECT document_id, i AS sentence_id, text, start, \"end\" FROM ({trimmed('(' + found('[^.!?;' + chr(10) + ']+[.!?;]*', 'said') + ')', SPACE, SPACE, 'document_id, i')})", "said")
END_CLASS = r"\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}"
define("lines", found(rf"[^{END_CLASS}]*(?:\r\n|[{END_CLASS}])|[^{END_CLASS}]+"), "docs")
define(
    "heads",
    "SELECT document_id, start, CASE "
    + " ".join(f"WHEN regexp_matches(trim(regexp_replace(text, '[\\r\\n]+$', ''), ' ' || chr(9) || ':-'), {quoted(p)}) THEN {quoted(n)}" for n, p in Q.HEADINGS)
    + " END AS section_name FROM lines",
    "lines",
)
define(
    "sec",
    """
  SELECT document_id, section_name, start::INTEGER AS start, coalesce(lead(start) OVER (PARTITION BY document_id ORDER BY start), size)::INTEGER AS "end" FROM (
    SELECT h.document_id, section_name, start, length(raw_text) AS size FROM heads h JOIN docs USING (document_id) WHERE section_name IS NOT NULL
    UNION ALL SELECT document_id, 'PREAMBLE', 0, length(any_value(raw_text)) FROM heads JOIN docs USING (document_id) WHERE section_name IS NOT NULL GROUP BY document_id HAVING min(start) > 0
    UNION ALL SELECT document_id, 'UNKNOWN', 0, length(raw_text) FROM docs WHERE document_id NOT IN (SELECT document_id FROM heads WHERE section_name IS NOT NULL))""",
    "heads",
    "docs",
)
ALIASES = ", ".join(f"({quoted(L.VOCABULARIES[t])}, {quoted(t)}, {quoted(i)}, {n}, {p}, {quoted(a)})" for n, (t, i, names) in enumerate(Q.RECORDS) for p, a in enumerate(names))
define("kb", f"SELECT *, {norm('alias')} AS norm FROM (VALUES {ALIASES}) AS t(vocabulary, type, candidate_id, ord, place, alias)")
define(
    "phr",
    f"""
  SELECT phrase, string_split(phrase, ' ') AS words, string_split(phrase, ' ')[1] AS first, len(string_split(phrase, ' ')) AS n, type, candidate_id,
    row_number() OVER (PARTITION BY phrase ORDER BY o, type, candidate_id)::INTEGER AS ord
  FROM (SELECT norm AS phrase, type, candidate_id, min(ord * 1000 + place) AS o FROM kb
        WHERE length(norm) >= 4 AND NOT regexp_matches(norm, '^\\p{{Nd}}+$') AND len(string_split(norm, ' ')) <= {Q.MOST_WORDS} AND (norm LIKE '% %' OR length(norm) >= 5) GROUP BY ALL)""",
    "kb",
)
define(
    "hits",
    f"""
  SELECT document_id, start, "end", {piece('raw_text', 'start', '"end"')} AS text, type, candidate_id, 0.94::DOUBLE AS confidence, {piece('raw_text', 'start', 'until')} AS mention_head, 'ontology_exact_phrase' AS evidence, ord
  FROM (SELECT document_id, raw_text, start, until, type, candidate_id, ord,
          (until + CASE WHEN type = 'DRUG' THEN length(regexp_extract(string_split(substring(raw_text, until + 1, 96), chr(10))[1], {quoted(Q.TAIL)})) ELSE 0 END)::INTEGER AS "end"
        FROM (SELECT t.document_id, t.i, t.start, t.ends[p.n] AS until, p.type, p.candidate_id, p.ord
              FROM (SELECT document_id, i, start, norm, list(norm) OVER w AS nx, list("end") OVER w AS ends FROM tok WINDOW w AS (PARTITION BY document_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {Q.MOST_WORDS - 1} FOLLOWING)) t
              JOIN phr p ON t.norm = p.first AND t.nx[1:p.n] = p.words QUALIFY p.n = max(p.n) OVER (PARTITION BY t.document_id, t.i)) JOIN docs USING (document_id))""",
    "tok",
    "phr",
    "docs",
)
define(
    "rules",
    " UNION ALL ".join(
        f"SELECT document_id, start, \"end\", text, {quoted(k)} AS type, NULL::VARCHAR AS candidate_id, 0.78::DOUBLE AS confidence, {f'regexp_extract(text, {quoted(h)})' if h else 'text'} AS mention_head, {quoted('rule_' + k.lower())} AS evidence, {1_000_000 + n} AS ord FROM ({found(p)})"
        for n, (k, p, h) in enumerate(Q.RULES)
    ),
    "docs",
)
define(
    "plain_hits",
    f"""
  SELECT * FROM hits h WHERE NOT (type = 'DISEASE' AND EXISTS (
    SELECT 1 FROM rules r WHERE r.type = 'SYMPTOM' AND r.document_id = h.document_id AND {norm('r.text')} = {norm('h.text')} AND h.start < r."end" AND r.start < h."end"))""",
    "hits",
    "rules",
)
define("detected", "SELECT * FROM plain_hits UNION ALL SELECT * FROM rules", "plain_hits", "rules")


def resolve(name: str, source: str, *needs: str) -> None:
    """Greedy choice among the spans of ``source``: a fold over each cluster in order of rank."""
    define(
        f"{name}_ranked",
        f"""
  SELECT *, row_number() OVER (PARTITION BY document_id, cl ORDER BY confidence DESC, start - "end", start, type, ord) AS rn, count(*) OVER (PARTITION BY document_id, cl) AS many
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY document_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS cl
        FROM (SELECT *, CASE WHEN coalesce(max("end") OVER (PARTITION BY document_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= start, true) THEN 1 ELSE 0 END AS fresh FROM {source}))""",
        *needs,
    )
    define(
        f"{name}_fold",
        f"""
  SELECT document_id, cl, rn, [{{'s': start, 'e': "end", 'n': rn}}] AS acc FROM {name}_ranked WHERE rn = 1
  UNION ALL
  SELECT r.document_id, r.cl, r.rn, CASE WHEN len(list_filter(f.acc, lambda x: x.s < r."end" AND r.start < x.e)) > 0 THEN f.acc ELSE list_append(f.acc, {{'s': r.start, 'e': r."end", 'n': r.rn}}) END
  FROM {name}_fold f JOIN {name}_ranked r ON r.document_id = f.document_id AND r.cl = f.cl AND r.rn = f.rn + 1""",
        f"{name}_ranked",
    )
    define(
        name,
        f"""
  SELECT document_id, start, "end", text, type, candidate_id, confidence, mention_head, evidence, ord FROM {name}_ranked r
  JOIN (SELECT document_id, cl, unnest(list_transform(acc, lambda x: x.n)) AS rn FROM (SELECT f.* FROM {name}_fold f JOIN {name}_ranked r USING (document_id, cl, rn) WHERE r.many = f.rn)) USING (document_id, cl, rn)""",
        f"{name}_fold",
    )


resolve("resolved", "detected", "detected")
define(
    "parts",
    """
  SELECT document_id, (start + coalesce(list_sum(list_transform(ps[1:k], lambda x: length(x) + 1)), 0)) AS start, ps[k + 1] AS text, type, candidate_id, confidence, mention_head, evidence, ord
  FROM (SELECT *, unnest(range(len(ps))) AS k FROM (SELECT *, string_split(text, chr(10)) AS ps FROM resolved))""",
    "resolved",
)
define(
    "cut",
    trimmed("(SELECT *, start + length(text) AS \"end\" FROM parts WHERE text <> '')", r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}\-*•+]", r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}\-*•+,;]", "document_id, type, candidate_id, confidence, mention_head, evidence, ord"),
    "parts",
)
resolve("ents", "cut", "cut")


def axis(text: str, cue: str) -> str:
    return f"regexp_matches({text}, {quoted(Q.CUES[cue])})"


define(
    "placed",
    f"""
  SELECT e.*, raw_text, {piece('raw_text', 'greatest(e.start - 55, 0)', 'e.start')} AS prefix, {piece('raw_text', 'greatest(e.start - 120, 0)', 'least(e."end" + 120, length(raw_text))')} AS context, coalesce(s.section_name, 'UNKNOWN') AS section_name
  FROM ents e JOIN docs USING (document_id) LEFT JOIN sec s ON s.document_id = e.document_id AND s.start <= e.start AND e."end" <= s."end" """,
    "ents",
    "docs",
    "sec",
)
define(
    "axes",
    f"""
  SELECT * EXCLUDE (raw_text, prefix, context), CASE WHEN {axis('prefix', 'negated')} THEN 'NEGATED' ELSE 'AFFIRMED' END AS polarity,
    CASE WHEN {axis('context', 'planned')} THEN 'PLANNED' WHEN {axis('context', 'resolved')} THEN 'RESOLVED' WHEN section_name IN ('HISTORY', 'FAMILY_HISTORY') OR {axis('context', 'historical')} THEN 'HISTORICAL' ELSE 'CURRENT' END AS temporality,
    CASE WHEN {axis('context', 'possible')} THEN 'POSSIBLE' ELSE 'CONFIRMED' END AS certainty,
    CASE WHEN section_name = 'FAMILY_HISTORY' OR {axis('prefix', 'family')} THEN 'FAMILY' ELSE 'PATIENT' END AS experiencer FROM placed""",
    "placed",
)
define(
    "related",
    f"""
  SELECT document_id, sentence_id, a.start AS subject_start, a."end" AS subject_end, a.type AS subject_type, b.start AS object_start, b."end" AS object_end, b.type AS object_type, relation,
    greatest(0, b.start - a."end", a.start - b."end")::INTEGER AS distance,
    round(greatest(0.5, 0.88::DOUBLE - greatest(0, b.start - a."end", a.start - b."end") / 256.0::DOUBLE * 0.25::DOUBLE), 6)::DOUBLE AS confidence
  FROM in_sent a JOIN in_sent b USING (document_id, sentence_id)
  JOIN (VALUES {', '.join(f'({quoted(s)}, {quoted(o)}, {quoted(r)})' for (s, o), r in L.RELATIONS.items())}) AS c(st, ot, relation) ON a.type = st AND b.type = ot
  WHERE greatest(0, b.start - a."end", a.start - b."end") <= 256""",
    "in_sent",
)
define("in_sent", 'SELECT e.document_id, e.start, e."end", e.type, s.sentence_id FROM ents e JOIN sent s ON s.document_id = e.document_id AND s.start <= e.start AND e."end" <= s."end"', "ents", "sent")


def vocabulary(kind: str) -> str:
    return f"CASE {kind} {' '.join(f'WHEN {quoted(t)} THEN {quoted(v)}' for t, v in L.VOCABULARIES.items())} END"


def bm25(name: str, corpus: str, queries: str, k: int, by: str = "") -> None:
    """``name``: the best ``doc`` of ``corpus`` (by, doc, norm) for ``queries`` (by, query, norm), with score and rank."""
    g = f"{by}, " if by else ""
    using = f"({g}term)"
    stats = f"USING ({by})" if by else "ON true"
    define(f"{name}_post", f"SELECT {g}doc, term, count(*) AS tf FROM (SELECT {g}doc, unnest(string_split(norm, ' ')) AS term FROM {corpus}) WHERE length(term) >= 2 GROUP BY ALL", corpus)
    define(f"{name}_ask", f"SELECT DISTINCT {g}query, term FROM (SELECT {g}query, unnest(string_split(norm, ' ')) AS term FROM {queries}) WHERE length(term) >= 2", queries)
    define(f"{name}_len", f"SELECT {g}doc, sum(tf) AS dl FROM {name}_post GROUP BY ALL", f"{name}_post")
    group = f"GROUP BY {by}" if by else ""
    define(f"{name}_stat", f"SELECT {g}n_docs, all_terms FROM (SELECT {g}count(DISTINCT doc) AS n_docs FROM {corpus} {group}) a JOIN (SELECT {g}sum(dl) AS all_terms FROM {name}_len {group}) b {stats}", f"{name}_len")
    define(
        name,
        f"""
  SELECT {g}query, doc, score, row_number() OVER (PARTITION BY {g}query ORDER BY round(score, 6) DESC, doc)::INTEGER AS rank FROM (
    SELECT {g}query, doc, sum(ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (all_terms::DOUBLE / n_docs)))) AS score
    FROM {name}_post JOIN {name}_ask USING {using} JOIN (SELECT {g}term, count(*) AS df FROM {name}_post GROUP BY ALL) USING {using} JOIN {name}_len USING ({g}doc) JOIN {name}_stat {stats}
    GROUP BY {g}query, doc) QUALIFY rank <= {k}""",
        f"{name}_post",
        f"{name}_ask",
        f"{name}_len",
        f"{name}_stat",
    )


def grams(text: str, least: int, most: int) -> str:
    """Distinct n-grams of a normalised text."""
    t = f"replace({text}, ' ', '_')"
    lists = ", ".join(f"list_transform(range(greatest(length({t}) - {n} + 1, 0)), lambda i: substring({t}, (i + 1)::INTEGER, {n}))" for n in range(least, most + 1))
    return f"list_distinct(flatten([{lists}]))"


def set_jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"


define("names", "SELECT vocabulary, candidate_id || '#' || place AS doc, candidate_id, norm FROM kb WHERE norm <> ''", "kb")
define("asked", f"SELECT DISTINCT vocabulary, norm AS query, norm FROM (SELECT {vocabulary('type')} AS vocabulary, {norm('text')} AS norm FROM ents) WHERE vocabulary IS NOT NULL AND norm <> ''", "ents")
bm25("words", "names", "asked", 50, "vocabulary")
define("name_grams", f"SELECT *, {grams('norm', 2, 5)} AS gs, {grams('norm', 3, 3)} AS g3 FROM names", "names")
define("asked_grams", f"SELECT *, {grams('norm', 2, 5)} AS gs, {grams('norm', 3, 3)} AS g3 FROM asked", "asked")
define(
    "shapes",
    f"""
  SELECT vocabulary, query, doc, candidate_id, row_number() OVER (PARTITION BY vocabulary, query ORDER BY round(score, 6) DESC, doc)::INTEGER AS rank FROM (
    SELECT vocabulary, q.query, n.doc, n.candidate_id, {set_jaccard('q.gs', 'n.gs')} AS score FROM asked_grams q JOIN name_grams n USING (vocabulary) WHERE list_has_any(q.g3, n.g3)) QUALIFY rank <= 50""",
    "name_grams",
    "asked_grams",
)


def fused(name: str, a: str, b: str, by: str, key: str, k: int, *needs: str) -> None:
    define(
        name,
        f"""
  SELECT {by}, {key}, score, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, {key})::INTEGER AS rank FROM (
    SELECT {by}, {key}, round(coalesce(0.6::DOUBLE / (a + 60), 0) + coalesce(0.4::DOUBLE / (b + 60), 0), 6) AS score
    FROM (SELECT {by}, {key}, min(rank) AS a FROM {a} GROUP BY ALL) FULL OUTER JOIN (SELECT {by}, {key}, min(rank) AS b FROM {b} GROUP BY ALL) USING ({by}, {key})) QUALIFY rank <= {k}""",
        *needs,
    )


define("words_c", "SELECT w.*, candidate_id FROM words w JOIN names USING (vocabulary, doc)", "words", "names")
fused("cands", "words_c", "shapes", "vocabulary, query", "candidate_id", 10, "words_c", "shapes")
define(
    "linked",
    f"""
  SELECT a.*, {vocabulary('type')} AS vocabulary, coalesce(found, []::VARCHAR[]) AS candidates FROM axes a
  LEFT JOIN (SELECT vocabulary AS v, query, list(candidate_id ORDER BY rank) AS found FROM cands GROUP BY ALL) ON v = {vocabulary('a.type')} AND query = {norm('a.text')}""",
    "axes",
    "cands",
)


def official(kind: str) -> str:
    return f"CASE {kind} {' '.join(f'WHEN {quoted(t)} THEN {quoted(o)}' for t, o in L.OFFICIAL_TYPES.items())} END"


def with_key(key: str) -> str:
    return "(" + ", ".join(quoted(t) for t, o in L.OFFICIAL_TYPES.items() if key in L.OFFICIAL_KEYS[o]) + ")"


define(
    "submitted",
    f"""
  SELECT document_id, text, {official('type')} AS type, [start, "end"] AS position,
    CASE WHEN type IN {with_key('assertions')} THEN list_filter([CASE WHEN polarity = 'NEGATED' THEN 'isNegated' END, CASE WHEN temporality = 'HISTORICAL' THEN 'isHistorical' END, CASE WHEN experiencer = 'FAMILY' THEN 'isFamily' END], lambda x: x IS NOT NULL) END AS assertions,
    CASE WHEN type IN {with_key('candidates')} THEN candidates END AS candidates
  FROM linked WHERE {official('type')} IS NOT NULL""",
    "linked",
)
define("bio", """SELECT document_id, i, start, "end", CASE WHEN s IS NULL THEN 'O' WHEN lag(s) OVER w = s AND lag(e) OVER w = e AND lag(t) OVER w = t THEN 'I-' || t ELSE 'B-' || t END AS label
FROM (SELECT k.document_id, k.i, k.start, k."end", x.start AS s, x."end" AS e, x.type AS t FROM tok k LEFT JOIN ents x ON x.document_id = k.document_id AND k.start < x."end" AND x.start < k."end"
      QUALIFY row_number() OVER (PARTITION BY k.document_id, k.i ORDER BY x.start, x."end", x.type) = 1) WINDOW w AS (PARTITION BY document_id ORDER BY i)""", "tok", "ents")
define("spans", 'SELECT DISTINCT document_id, start, "end", type FROM ents', "ents")



def prf(tp: str, fp: str, fn: str) -> str:
    p, r = f"coalesce({tp}::DOUBLE / nullif({tp} + {fp}, 0), 0)", f"coalesce({tp}::DOUBLE / nullif({tp} + {fn}, 0), 0)"
    return f"round({p}, 6) AS precision, round({r}, 6) AS recall, round(coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0), 6) AS f1"
