"""Shared small pieces of the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def two_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text only, so that no further column can clash with what is added."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def give_back() -> None:
    """Memory that a Python worker has freed goes back to the system. Workers outlive their tasks, and
    what they keep counts against the executor while later stages run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn`` for ``mapInArrow``, after which the worker keeps no memory it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return run


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], limit: int = 1 << 18, col: str = "text"):
    """For ``mapInArrow``: ``fn`` gets slices of about ``limit`` bytes of ``col``."""
    from replyloom.llm.words import pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in pieces(batch.column(col), limit):
                out = fn(batch.slice(first, len(part)))
                if out is not None and out.num_rows:
                    yield out

    return giving_back(run)


def id_remainder(ids: pa.Array, mod: int):
    """crc32 of each id as text, modulo ``mod``; -1 for NULL."""
    return [-1 if i is None else zlib.crc32(str(i).encode()) % mod for i in ids.to_pylist()]
