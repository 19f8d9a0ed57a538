"""Embedding cache keyed by model and text hash."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BUCKETS = 16


def text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def key_bucket(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def missing_texts(texts: DataFrame, cache: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Distinct text keys that ``cache(model, text_key)`` lacks. Repeats collapse
    before the join, so a hot text is one row."""
    wanted = texts.select(text_key(F.col(text)).alias("text_key")).distinct()
    have = cache.filter(F.col("model") == model).select("text_key")
    return wanted.join(have, "text_key", "left_anti")


def new_batch() -> str:
    """A name for one writer's append: earlier ones sort first, no two are equal."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"


def append_vectors(vectors: DataFrame, path: str, batch: str | None = None, buckets: int = BUCKETS) -> str:
    """Append ``(model, text_key, embedding)`` as a batch of its own; its name comes back.

    Writers never touch each other's files: rows lie by model, bucket of the key and batch, and a batch
    that is written again under its name replaces itself. Two writers may both store a
    text; ``read_cache`` settles that.
    """
    batch = batch or new_batch()
    rows = vectors.select("model", "text_key", "embedding", key_bucket(F.col("text_key"), buckets).alias("_bucket"), F.lit(batch).alias("_batch"))
    placed = rows.repartition("model", "_bucket")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "_bucket", "_batch").parquet(path)
    return batch


def read_cache(spark: SparkSession, path: str, model: str, wanted: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """model, text_key, embedding: one vector a text, that of the least batch that stored it; of rows
    that one batch repeats the least vector. ``wanted(text_key)``: only those texts, whose buckets alone are read."""
    stored = T.StructType.fromDDL("text_key string, embedding array<double>, model string, _bucket int, _batch string")
    rows = spark.read.schema(stored).parquet(path).filter(F.col("model") == model)
    if wanted is not None:
        keys = wanted.select("text_key").distinct().withColumn("_bucket", key_bucket(F.col("text_key"), buckets))
        rows = rows.join(keys, ["_bucket", "text_key"], "left_semi")
    first = F.min(F.struct("_batch", "embedding"))["embedding"].alias("embedding")
    return rows.groupBy("model", "text_key").agg(first)
