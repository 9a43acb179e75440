"""The queries op1_ to op10_ and ``pipeline`` over the tables of a test directory, and their SQL."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import license_scan as lic
from . import url_filter as url
from .bpe import bpe_digests
from .common import SPACE, WORD, table
from .exact_dedup import exact_dedup
from .hilbert_shards import hilbert_shards
from .license_library import more_texts
from .license_texts import LICENSES
from .maxent_lm import lm_scores
from .minhash import near_duplicates
from .mixing import mix_sources
from .toxicity import toxicity
from .transport_stream import media_features, store

#: Vocabulary file of the queries, a parameter of the operators.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(store(table(spark, sf_dir, "documents")))


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hilbert_shards(table(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


#: Target weights of the query's mix: the domain of a source is the last character of its name, modulo 4.
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 60, 2, 17
MIX_WEIGHTS: dict[tuple[str, ...], int] = {("d0",): 1, ("d1",): 3, ("d2",): 3, ("d3",): 2, ("d1", "en"): 2, ("d1", "fr"): 3, ("d2", "de"): 4, ("d0", "en", "src0"): 5, ("d3", "es", "src3"): 4}


def source_domain() -> Column:
    return F.concat(F.lit("d"), F.ascii(F.right(F.coalesce("source", F.lit("")), F.lit(1))) % 4)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), source_domain(), MIX_PERCENT, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url.url_filter(table(spark, sf_dir, "pages"))


def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lic.license_scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_bpe": op2_bpe,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_transport_stream": op5_transport_stream,
    "op6_hilbert_shards": op6_hilbert_shards,
    "op7_mixing": op7_mixing,
    "op8_url_filter": op8_url_filter,
    "op9_maxent_lm": op9_maxent_lm,
    "op10_license_scan": op10_license_scan,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _like(text: str) -> str:
    return text.replace("!", "!!").replace("%", "!%").replace("_", "!_")


def _url_sql() -> str:
    cases = []
    for rule, verdict in sorted(url.RULES, key=lambda r: -len(r[0])):
        host, slash, rest = rule.partition("/")
        fits = f"(host = {_quoted(host)} OR host LIKE {_quoted('%.' + _like(host))} ESCAPE '!') AND starts_with(path, {_quoted(slash + rest)})"
        cases.append((fits, rule, verdict))
    own = []
    for glob in url.BLOCK_GLOBS:
        if glob.startswith("~.") and "/" not in glob:
            own.append(f"('.' || host) LIKE {_quoted('%.' + _like(glob[2:].rstrip('*')) + '%')} ESCAPE '!'")
        elif glob.startswith("~.") and glob.endswith("/*"):
            own.append(f"(('.' || host) LIKE {_quoted('%.' + _like(glob[2:-2]))} ESCAPE '!' AND path <> '')")
        else:
            own.append(f"('.' || host || path) LIKE {_quoted(_like(glob).replace('*', '%'))} ESCAPE '!'")
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://([^?#]*)', 1) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '(?s)/.*$') AS path FROM rest
)
SELECT page_id, host, path,
  CASE {' '.join(f'WHEN {fits} THEN {_quoted(rule)}' for fits, rule, _ in cases)} ELSE NULL END AS rule,
  CASE {' '.join(f'WHEN {fits} THEN {_quoted(verdict)}' for fits, _, verdict in cases)} WHEN {' OR '.join(own)} THEN 'block' ELSE 'allow' END AS verdict
FROM parts"""


def _plain_form(text: str) -> str:
    """The canonical form of a license text, in Python alone."""
    lower = text.lower().replace("\r", "\n")
    body = re.sub(lic.COPYRIGHT_LINE, " ", lower, flags=re.MULTILINE)
    spelled = dict(lic.SPELLINGS)
    return " ".join(spelled.get(w, w) for w in regex.split(lic.BETWEEN, body) if w)


def _license_sql() -> str:
    known: dict[str, str] = {}
    for name, text in [*LICENSES.items(), *more_texts()]:
        digest = hashlib.sha256(_plain_form(text).encode()).hexdigest()
        known[digest] = min(name, known.get(digest, name))
    body = f"regexp_replace(replace(lower(coalesce(text, '')), chr(13), chr(10)), {_quoted('(?m)' + lic.COPYRIGHT_LINE)}, ' ', 'g')"
    spelled = "map {" + ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in lic.SPELLINGS) + "}"
    form = f"array_to_string(list_transform(string_split(trim(regexp_replace({body}, {_quoted(lic.BETWEEN)}, ' ', 'g'), ' '), ' '), lambda w: coalesce({spelled}[w], w)), ' ')"
    return f"""
WITH known(canonical_sha256, license_id) AS (VALUES {', '.join(f'({_quoted(d)}, {_quoted(n)})' for d, n in sorted(known.items()))}),
forms AS (SELECT doc_id, {form} AS form FROM documents)
SELECT f.doc_id, length(f.form)::BIGINT AS n_canonical, sha256(f.form) AS canonical_sha256, k.license_id
FROM forms f LEFT JOIN known k ON sha256(f.form) = k.canonical_sha256"""


def _weight_sql(depth: int, names: list[str]) -> str:
    cases = [f"WHEN {' AND '.join(f'{n} = {_quoted(v)}' for n, v in zip(names, path, strict=False))} THEN {w}" for path, w in sorted(MIX_WEIGHTS.items()) if len(path) == depth]
    return f"CASE {' '.join(cases)} ELSE 1 END"


def _divide_sql(name: str, parent: list[str], child: str) -> str:
    """CTEs ``{name}_shared`` from ``{name}_in`` (parent, child, capacity, weight, budget): shares of the parents' budgets."""
    p = ", ".join(parent)
    keys = ", ".join([*parent, child])
    return f"""{name}_wide AS (
  SELECT *, budget - coalesce(sum(capacity) OVER (PARTITION BY {p} ORDER BY fill, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spare,
    sum(weight) OVER (PARTITION BY {p} ORDER BY fill, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM (SELECT *, capacity::DOUBLE / weight AS fill FROM {name}_in WHERE weight > 0)
), {name}_full AS (SELECT *, capacity * open <= spare * weight AS is_full FROM {name}_wide
), {name}_rest AS (
  SELECT *, max(CASE WHEN NOT is_full THEN spare END) OVER (PARTITION BY {p}) AS rest, max(CASE WHEN NOT is_full THEN open END) OVER (PARTITION BY {p}) AS open_all FROM {name}_full
), {name}_part AS (
  SELECT *, CASE WHEN is_full THEN capacity ELSE rest * weight // open_all END AS share0,
    sum(CASE WHEN is_full THEN 0 ELSE 1 END) OVER (PARTITION BY {p} ORDER BY fill, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM {name}_rest
), {name}_shared AS (
  SELECT {keys}, share0 + CASE WHEN NOT is_full AND place <= rest - sum(CASE WHEN is_full THEN 0 ELSE share0 END) OVER (PARTITION BY {p}) THEN 1 ELSE 0 END AS share FROM {name}_part
)"""


def mixing_sql(docs: str = "documents") -> str:
    leaf = ["domain", "lang", "source"]
    return f"""
WITH mix_rows AS (
  SELECT doc_id, 'd' || (ascii(right(coalesce(source, ''), 1)) % 4) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source, md5(coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens FROM {docs}
), leaves AS (SELECT domain, lang, source, count(*) AS n, sum(n_tokens)::HUGEINT AS tokens FROM mix_rows GROUP BY ALL
), nodes AS (SELECT *, CASE WHEN {_weight_sql(3, leaf)} > 0 THEN tokens * {MIX_EPOCHS} ELSE 0 END AS capacity FROM leaves
), langs AS (SELECT domain, lang, CASE WHEN {_weight_sql(2, leaf)} > 0 THEN sum(capacity)::HUGEINT ELSE 0 END AS capacity FROM nodes GROUP BY domain, lang
), a_in AS (SELECT 0 AS root, domain, sum(capacity)::HUGEINT AS capacity, {_weight_sql(1, leaf)}::HUGEINT AS weight, (SELECT sum(tokens)::HUGEINT * {MIX_PERCENT} // 100 FROM leaves) AS budget FROM langs GROUP BY domain
), {_divide_sql("a", ["root"], "domain")
}, b_in AS (SELECT domain, lang, capacity, {_weight_sql(2, leaf)}::HUGEINT AS weight, share AS budget FROM langs JOIN a_shared USING (domain)
), {_divide_sql("b", ["domain"], "lang")
}, c_in AS (SELECT domain, lang, source, capacity, {_weight_sql(3, leaf)}::HUGEINT AS weight, share AS budget FROM nodes JOIN b_shared USING (domain, lang)
), {_divide_sql("c", ["domain", "lang"], "source")
}, shares AS (
  SELECT *, share - whole * tokens AS rest FROM (
    SELECT domain, lang, source, tokens, coalesce(share, 0) AS share, CASE WHEN tokens > 0 THEN least(coalesce(share, 0) // tokens, {MIX_EPOCHS}) ELSE 0 END AS whole FROM leaves LEFT JOIN c_shared USING (domain, lang, source))
), placed AS (
  SELECT *, md5('{MIX_SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, '') || ':' || digest) AS place FROM mix_rows JOIN shares USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens, share::BIGINT AS leaf_share,
  (whole + CASE WHEN rest > 0 AND sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) <= rest THEN 1 ELSE 0 END)::INTEGER AS copies
FROM placed"""


ORACLE_SQL: dict[str, str] = {
    "op7_mixing": mixing_sql(),
    "op3_exact_dedup": f"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[{SPACE}]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)""",
    "op8_url_filter": _url_sql(),
    "op10_license_scan": _license_sql(),
}
