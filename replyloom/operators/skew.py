"""Joining rows to per-key facts when one key may own a large share of the rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F


def _hash(keys: list[str]) -> Column:
    """A key's hash; NULL differs from every text."""
    return F.xxhash64(*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys])


def lookup_counted(
    rows: DataFrame, groups: DataFrame, keys: list[str], count_col: str, unique: Column, parts: int | None = None
) -> DataFrame:
    """Inner join of ``rows`` to ``groups``, the latter one row per key, where
    ``count_col`` says how many of the rows carry the key and ``unique`` differs
    from row to row. NULL keys match NULL keys and nothing else.

    Keys meet by a hash and are compared after it, so texts are no shuffle keys. The
    ``parts`` most frequent keys are broadcast as hashes: four for each shuffle partition unless
    given, so that any other key owns less than a quarter of a partition's share of the rows.
    Rows settled that way join the shuffled side under their own ``unique`` value: they match
    nothing there and spread evenly instead of following their hot key. Which of
    several equally frequent keys is broadcast does not matter, since the shuffled
    side keeps them all.
    """
    parts = parts or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    facts = [c for c in groups.columns if c not in keys]
    hashed = groups.select(_hash(keys).alias("_h"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*facts).alias("_facts"), count_col)
    hot = hashed.orderBy(F.desc(count_col)).limit(parts).select("_h", *[F.col(f"_k{i}").alias(f"_b{i}") for i in range(len(keys))], F.col("_facts").alias("_hot"))
    cold = hashed.select(F.col("_h").alias("_key"), *[F.col(f"_k{i}") for i in range(len(keys))], F.col("_facts").alias("_cold"))
    same = lambda mark: [F.col(k).eqNullSafe(F.col(f"{mark}{i}")) for i, k in enumerate(keys)]
    both = lambda conditions: functools.reduce(lambda a, b: a & b, conditions)
    left = rows.withColumn("_rh", _hash(keys))
    spread = left.join(F.broadcast(hot), both([F.col("_rh") == F.col("_h"), *same("_b")]), "left").withColumn(
        "_to", F.when(F.col("_hot").isNull(), F.col("_rh")).otherwise(F.xxhash64(unique))
    )
    return (
        spread.join(cold, both([F.col("_to") == F.col("_key"), *same("_k")]), "left")
        .withColumn("_found", F.coalesce("_hot", "_cold"))
        .filter(F.col("_found").isNotNull())
        .select(*rows.columns, "_found.*")
    )
