"""Seeded stratified split with an exact quota per class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from replyloom.domain import EVAL_RATIO, INTENTS, SEED
from replyloom.functions.text import seeded_hash


def stratified_split(
    pairs: DataFrame,
    *,
    label: str = "label",
    key: str = "id",
    ratio: float = EVAL_RATIO,
    seed=SEED,
    classes=INTENTS,
    digits: int = 4,
) -> DataFrame:
    """Add ``split``: the ``max(1, round(ratio*n))`` rows of each class that come
    first by seeded hash are ``eval``, the others ``train``.

    Four classes must not mean four tasks. A histogram of hash prefixes finds the
    prefix in which the quota runs out; only rows of that prefix (one in 16^digits)
    are ranked to find the exact last row. The result is one (hash, key) cut per
    class, at most ``len(classes)`` rows, which every row is compared with in place:
    the data set itself is never shuffled.
    """
    rows = pairs.filter(F.col(label).isin(*classes))
    keyed = rows.select(F.col(label).alias("_l"), F.col(key).alias("_k"), seeded_hash(seed, F.col(key)).alias("_h"))
    prefix = F.substring("_h", 1, digits)

    per_class = W.partitionBy("_l")
    hist = (
        keyed.groupBy("_l", prefix.alias("_b"))
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_cum", F.sum("_c").over(per_class.orderBy("_b")))
        .withColumn("_n", F.sum("_c").over(per_class))
        .withColumn("_quota", F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(ratio)).cast("bigint")))
        .withColumn("_before", F.col("_cum") - F.col("_c"))
    )
    edge = hist.filter((F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_cum"))).select(
        F.col("_l"), F.col("_b"), (F.col("_quota") - F.col("_before")).alias("_left")
    )
    cut = (
        keyed.withColumn("_b", prefix)
        .join(F.broadcast(edge), ["_l", "_b"])
        .withColumn("_rank", F.row_number().over(per_class.orderBy("_h", "_k")))
        .filter(F.col("_rank") == F.col("_left"))
        .select(F.col("_l").alias(label), F.col("_h").alias("_cut_h"), F.col("_k").alias("_cut_k"))
    )
    h = seeded_hash(seed, F.col(key))
    chosen = (h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (F.col(key) <= F.col("_cut_k")))
    return (
        rows.join(F.broadcast(cut), label, "left")
        .withColumn("split", F.when(chosen, F.lit("eval")).otherwise(F.lit("train")))
        .drop("_cut_h", "_cut_k")
    )
