"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

``plan`` gives every document the number of words the mix takes of it. Sources share a total
by weight; a source whose share passes ``max_epochs`` times its size is clamped there and what
it cannot give is shared again among the others by weight, until none is above. A share is then
a number of whole repetitions of a source and a rest: the rest goes once more over the source's
documents in seeded order until it runs out, in the last document possibly part way.

Everything is DataFrame functions. Texts are read once, for their sizes; what follows works on
a slim table of keys and sizes. No source is gathered in one task: rounds of the water-filling
are sums over one row a source, of which the driver sees three numbers, and the place where a
rest runs out is found through histograms of key prefixes (4,096 a level), not by sorting. Every
document is then compared with its source's one cut in place.

Defined results: NULL and empty texts have size 0 and take 0. A NULL source is a source like any
other. A weight that is NULL, not positive or missing gives a target of 0; of repeated weight rows
of one source the largest counts. If all sources together cannot give the total, each gives its
maximum. Rows that agree in id and text take equal parts of what falls on them together (rounded
down), so their order does not matter; rows of one id with unlike texts, and rows without an id,
are documents of their own. Empty tables give empty results. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replyloom.operators.skew import lookup_counted
from replyloom.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]"
MAX_EPOCHS, SEED = 3, 20250117
#: hexadecimal digits of a key in one histogram, and the histograms one after another
DIGITS, LEVELS = 3, 2


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "++")), F.lit(0)).cast("bigint")


def _slim(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str, more: dict[str, Column]) -> DataFrame:
    text, key = F.col(text_col).cast("string"), F.col(id_col).cast("string")
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key, F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words_in(text).alias("size"), place.alias("place"), *[c.alias(n) for n, c in more.items()])


def water_level(sources: DataFrame, total: int, max_epochs: int) -> tuple[int, int]:
    """(words, weight): every unclamped source gets weight x words / weight.

    Clamping only raises the level, so the level alone says which sources are clamped: those whose
    share at it passes their maximum. Each round is one aggregation of one row a source.
    """
    weight, cap = F.col("weight"), F.col("source_size") * F.lit(max_epochs).cast("decimal(9,0)")
    level = (0, 1)
    while True:
        clamped = (weight * F.lit(level[0]).cast("decimal(20,0)") > cap * F.lit(level[1]).cast("decimal(20,0)")) if level[0] else F.lit(False)
        given, free = sources.agg(F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, weight))).first()
        if not free:
            return level
        following = (int(total - (given or 0)), int(free))
        if following == level:
            return level
        level = following


def shares(sizes: DataFrame, weights: DataFrame, *, total: int | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, n_docs, source_size, target, whole (repetitions), rest (words) of every source.

    ``sizes``: source, size for every document; ``weights``: source, weight (whole numbers). Sums
    and comparisons are exact decimals; only the last division of a target is a double.
    """
    known = weights.select(F.col("source").cast("string").alias("source"), F.greatest(F.coalesce(F.col("weight"), F.lit(0)), F.lit(0)).cast("decimal(9,0)").alias("weight"))
    known = known.groupBy(F.col("source").alias("_w")).agg(F.max("weight").alias("weight"))
    sums = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").cast("decimal(20,0)").alias("source_size"))
    table = sums.join(known, F.col("source").eqNullSafe(F.col("_w")), "left").withColumn("weight", F.coalesce("weight", F.lit(0).cast("decimal(9,0)"))).drop("_w")
    table = cut_lineage(table, "mix-sources")
    if total is None:
        total = int(table.agg(F.sum("source_size")).first()[0] or 0)
    words, weight = water_level(table, total, max_epochs)
    share = F.col("weight") * F.lit(words).cast("decimal(20,0)")
    most = F.col("source_size") * F.lit(max_epochs).cast("decimal(9,0)")
    target = F.when(share > most * F.lit(weight).cast("decimal(20,0)"), most.cast("double")).otherwise(share.cast("double") / F.lit(float(weight)))
    size, budget = F.col("source_size").cast("bigint"), F.floor("target").cast("bigint")
    out = table.select("source", "n_docs", size.alias("source_size"), target.alias("target"))
    whole = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0).cast("bigint")
    return out.withColumn("whole", whole).withColumn("rest", F.when(F.col("source_size") > 0, budget - F.col("whole") * F.col("source_size")).otherwise(0))


def _cuts(slim: DataFrame, shared: DataFrame) -> DataFrame:
    """source, cut, part: documents placed before ``cut`` give their whole size once more, those at
    it ``part`` words. One row for each source with a rest; others have none."""
    by_source = W.partitionBy("source")
    sources = shared.filter("rest > 0").select("source", "n_docs", F.col("rest").alias("left"), F.lit("").alias("prefix"))
    rows = slim.filter("size > 0").select("source", "place", "size")
    for level in range(1, LEVELS + 2):
        longer = F.col("place") if level > LEVELS else F.substring("place", 1, DIGITS * level)
        # first all rows of a source, then those below the prefix where its rest ran out
        near = lookup_counted(rows, sources, ["source"], "n_docs", F.col("place")).filter(F.col("place").startswith(F.col("prefix")))
        hist = near.groupBy("source", "n_docs", "left", longer.alias("prefix")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("docs"))
        run = hist.withColumn("upto", F.sum("n").over(by_source.orderBy("prefix")))
        met = run.filter("upto >= left and upto - n < left")
        sources = cut_lineage(met.select("source", "n_docs", (F.col("left") - F.col("upto") + F.col("n")).alias("left"), "prefix", "docs"), "mix-edge")
    return sources.select("source", F.col("prefix").alias("cut"), F.floor(F.col("left") / F.col("docs")).cast("bigint").alias("part"))


def plan(
    docs: DataFrame, weights: DataFrame, *, total: int | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", more: dict[str, Column] | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, whole, extra, taken for every document.

    A document is taken ``whole`` times and then its first ``extra`` words once more; ``taken`` is
    the words of both. A source's ``taken`` sum to its target rounded down (less at most one word for
    each copy of the one document where the rest ends). ``total``: words to share, all sizes unless
    given. ``more``: further columns to carry, by name.
    """
    more = more or {}
    slim = cut_lineage(_slim(docs, seed, id_col, text_col, source_col, more), "mix-sizes")
    shared = cut_lineage(shares(slim, weights, total=total, max_epochs=max_epochs), "mix-shares")
    cuts = _cuts(slim, shared).withColumnRenamed("source", "_s")
    facts = shared.join(cuts, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    found = lookup_counted(slim, facts, ["source"], "n_docs", F.col("place"))
    extra = F.when(F.col("place") < F.col("cut"), F.col("size")).when(F.col("place") == F.col("cut"), F.least("part", "size")).otherwise(0).cast("bigint")
    taken = (F.col("whole") * F.col("size") + F.col("extra")).alias("taken")
    return found.withColumn("extra", extra).select("doc_id", "source", "size", "source_size", "target", "whole", "extra", taken, *more)


def mixture(docs: DataFrame, weights: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: document (all columns of the row, in one struct), copy (from 0), text.

    A document appears ``whole`` times with its text as it is and, if it has extra words, once
    more: whole again, or cut after that many words where the rest of its source ran out.
    """
    planned = plan(docs, weights, text_col=text_col, more={"document": F.struct(*docs.columns)}, **options)
    text = F.col("document")[text_col].cast("string")
    number = F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)
    copies = planned.filter(number > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), number - 1)))
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*+{WORD}++"), F.lit(0)), F.lit(1), F.greatest(F.col("extra"), F.lit(1)).cast("int")), "")
    partial = (F.col("copy") == F.col("whole")) & (F.col("extra") < F.col("size"))
    return copies.select("document", "copy", F.when(partial, head).otherwise(text).alias("text"))


def ranked_weights(docs: DataFrame, weight: Callable[[Column], Column], source_col: str = "source") -> DataFrame:
    """source, weight, where the weight is a function of a source's rank (from 0) by code point,
    NULL last. One row a source is ranked: as many as a mix has weights."""
    names = docs.select(F.col(source_col).cast("string").alias("source")).distinct()
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    return names.select("source", weight(rank).alias("weight"))
