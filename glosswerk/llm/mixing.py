"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

Leaves are (domain, language, source).  A budget of tokens goes down the tree:
at each node it is divided among the children by their weights, and a child
gets no more than its leaves hold (their tokens times the epochs allowed).
What a child can't take goes to its siblings in proportion to their weights,
and only when all of them are full is it missing from the node's own demand,
where the node's siblings get it.  All numbers are integers, so shares add up
exactly: what rounding leaves goes to the first children in the order below.

A leaf's tokens come as a sequence of epochs, each a permutation of its rows
by a seeded digest of id and text; the leaf's share is a prefix of that
sequence.  Whole epochs count for every row, and one more for rows up to the
last place whose running sum stays within the rest.  Rows of one place are
added up before anything moves; the running sum over places is made of sums
over ranges of digests and of sums within one range, and the number of ranges
follows the leaf's rows, so a leaf with a third of all rows is many tasks.  A
leaf's last place is one value, which its rows meet in a join by leaf.

Order of children: tokens they can take for their weight, then their name.  The
children of one node are sorted by one task: as many rows as a domain has
languages, or a language has sources.

Defined results: tokens are words (runs without white space); a null or empty
text has none, and is taken if its place in the epoch is within the share.
Null domains, languages and sources are values of their own, named ``''``.
Rows with equal ids and texts have the same place, and are taken or left
together.  A weight that isn't given is 1; weights of 0 give nothing.  A budget above what
all leaves hold takes all.  An empty table gives an empty table.  Only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, forget, written

#: Expected rows in a range of digests.
RANGE_ROWS = 2048
#: Hex digits of a digest that number its range.
RANGE_DIGITS = 7
WIDE = "decimal(38,0)"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def seeded(seed: int, epoch: Column, key: Column, digest: Column) -> Column:
    """Digest that orders an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")), digest).cast("binary"))


def divide(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Children with their ``share`` of the parent's ``budget`` by ``weight``, at most ``capacity`` each.

    Children that are full come first in the order of capacity per weight; the
    first one that isn't divides what is left by weight with all later ones.
    """
    order = W.partitionBy(*parent).orderBy(F.col("fill"), F.col(child))
    upto = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(0, W.unboundedFollowing)
    wide = children.where("weight > 0").withColumn("fill", F.col("capacity").cast("double") / F.col("weight"))
    wide = wide.withColumn("left", F.col("budget").cast(WIDE) - F.coalesce(F.sum("capacity").over(upto), F.lit(0)).cast(WIDE)).withColumn("open", F.sum("weight").over(onward))
    full = wide.withColumn("full", F.col("capacity").cast(WIDE) * F.col("open") <= F.col("left") * F.col("weight"))
    # fill grows along the order, so the full ones are a prefix; what the rest divides is `left` of its first child
    whole = W.partitionBy(*parent)
    rest = full.withColumn("rest", F.max(F.when(~F.col("full"), F.col("left"))).over(whole)).withColumn("over", F.max(F.when(~F.col("full"), F.col("open"))).over(whole))
    share = F.expr("rest * weight div over")
    rest = rest.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(share).cast("long"))
    given = rest.withColumn("odd", (F.col("rest") - F.sum(F.when(~F.col("full"), F.col("share"))).over(whole)).cast("long")).withColumn("place", F.sum(F.when(~F.col("full"), 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0)))
    extra = F.when(~F.col("full") & (F.col("place") <= F.col("odd")), 1).otherwise(0)
    return given.withColumn("share", F.col("share") + extra).drop("fill", "left", "open", "full", "rest", "over", "odd", "place")


def budgets(leaves: DataFrame, budget: Column, epochs: int, weights: dict[tuple[str, ...], int] | None = None) -> DataFrame:
    """Leaves (domain, lang, source, n, tokens) with their ``share`` of ``budget``."""
    weights = weights or {}
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    levels = ["domain", "lang", "source"]
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)

    def weight(depth: int) -> Column:
        out = F.lit(1)
        for path, w in sorted(weights.items()):
            if len(path) == depth:
                same = F.lit(True)
                for name, value in zip(levels, path, strict=False):
                    same = same & (F.col(name) == F.lit(value))
                out = F.when(same, F.lit(w)).otherwise(out)
        return out.cast("long")

    # a node whose weight, or an ancestor's or all of its children's, is 0 can take nothing
    nodes = leaves.withColumn("capacity", F.when(weight(3) > 0, F.col("capacity")).otherwise(F.lit(0)))
    langs = nodes.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity")).withColumn("capacity", F.when(weight(2) > 0, F.col("capacity")).otherwise(F.lit(0)))
    domains = langs.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    shared = divide(domains.withColumn("weight", weight(1)).withColumn("budget", budget).withColumn("root", F.lit(0)), ["root"], "domain").select("domain", F.col("share").alias("budget"))
    shared = divide(langs.withColumn("weight", weight(2)).join(shared, "domain"), ["domain"], "lang").select("domain", "lang", F.col("share").alias("budget"))
    shared = divide(nodes.withColumn("weight", weight(3)).join(shared, ["domain", "lang"]), ["domain", "lang"], "source").select(*levels, "share")
    return leaves.drop("capacity").join(shared, levels, "left").withColumn("share", F.coalesce("share", F.lit(0)))


LEAF = ["domain", "lang", "source"]


def _leafed(docs: DataFrame, domain: Column, id_col: str, text_col: str, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    named = zip(LEAF, (domain, F.col(lang_col), F.col(source_col)), strict=True)
    return docs.select(F.col(id_col).alias("id"), *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in named), text_digest(F.col(text_col)).alias("digest"), *more)


def _cuts(rows: DataFrame, percent: int, epochs: int, weights: dict[tuple[str, ...], int] | None, seed: int) -> DataFrame:
    """Leaves with their ``share``, the ``full`` epochs in it, and the last place of one more (null: none) as ``cut``."""
    if epochs < 1 or percent < 0:
        raise ValueError("epochs must be at least 1, and percent at least 0")
    sizes = rows.groupBy(*LEAF).agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"))
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    shares = budgets(sizes, F.lit(total * percent // 100).cast("long"), epochs, weights)
    # whole epochs first; then a prefix of one more, of at most `rest` tokens
    shares = shares.withColumn("full", F.when(F.col("tokens") > 0, F.least(F.expr("share div tokens"), F.lit(epochs))).otherwise(F.lit(0)).cast("int"))
    shares = shares.withColumn("rest", F.col("share") - F.col("full") * F.col("tokens")).withColumn("ranges", F.ceil(F.col("n") / RANGE_ROWS).cast("long"))
    shares = written(shares.select(*LEAF, "share", "full", "rest", "ranges"), "mixing-shares")
    placed = rows.join(shares.where("rest > 0"), LEAF).withColumn("at", seeded(seed, F.col("full"), F.col("id"), F.col("digest")))
    number = F.conv(F.substring("at", 1, RANGE_DIGITS), 16, 10).cast("long")
    placed = placed.withColumn("range", F.floor(number * F.col("ranges") / F.lit(16**RANGE_DIGITS)))
    places = written(placed.groupBy(*LEAF, "range", "at").agg(F.sum("n_tokens").alias("own"), F.max("rest").alias("rest")), "mixing-places")
    sums = places.groupBy(*LEAF, "range").agg(F.sum("own").alias("own"))
    before = F.coalesce(F.sum("own").over(W.partitionBy(*LEAF).orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(*LEAF, "range", before.alias("before"))
    within = F.sum("own").over(W.partitionBy(*LEAF, "range").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow))
    inside = places.withColumn("within", within).join(starts, [*LEAF, "range"]).where("before + within <= rest")
    cuts = inside.groupBy(*LEAF).agg(F.max("at").alias("cut"))
    out = written(shares.select(*LEAF, "share", "full").join(cuts, LEAF, "left"), "mixing-cuts")
    forget(shares, places)
    return out


def _copies(seed: int) -> Column:
    at = seeded(seed, F.col("full"), F.col("id"), F.col("digest"))
    return (F.col("full") + F.when(at <= F.col("cut"), 1).otherwise(0)).cast("int")


def mix_sources(
    docs: DataFrame,
    domain: Column,
    percent: int = 50,
    epochs: int = 2,
    weights: dict[tuple[str, ...], int] | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, domain, lang, source, n_tokens, leaf_share, copies.

    The budget is ``percent`` of the tokens of all rows.  ``weights`` has a
    whole number for (domain,), (domain, lang) or (domain, lang, source).
    ``copies`` is how often the row is in the mix: 0 to ``epochs``.
    """
    rows = written(_leafed(docs, domain, id_col, text_col, lang_col, source_col, words_of(F.col(text_col)).alias("n_tokens")), "mixing-rows")
    taken = rows.join(_cuts(rows, percent, epochs, weights, seed), LEAF)
    return taken.select(F.col("id").alias(id_col), *LEAF, "n_tokens", F.col("share").alias("leaf_share"), _copies(seed).alias("copies"))


def drop_unmixed(docs: DataFrame, domain: Column, percent: int, weights: dict[tuple[str, ...], int] | None = None, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` without the rows that a mix of one epoch leaves out, each judged by its own leaf, id and text; all columns as they were."""
    rows = written(_leafed(docs, domain, id_col, text_col, lang_col, source_col, words_of(F.col(text_col)).alias("n_tokens")), "mixing-rows")
    cuts = _cuts(rows, percent, 1, weights, seed)
    forget(rows)
    whole = _leafed(docs, domain, id_col, text_col, lang_col, source_col, F.struct(*(F.col(c) for c in docs.columns)).alias("row"))
    return whole.join(cuts, LEAF).where(_copies(seed) > 0).select(*(F.col("row")[c].alias(c) for c in docs.columns))
