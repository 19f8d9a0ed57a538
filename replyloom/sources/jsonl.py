"""JSON lines in and out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from replyloom.domain import ADVERSARIAL_PREFIX, ADVERSARIAL_SCHEMA, CHAT_SCHEMA, HOLDOUT, RICH_SCHEMA
from replyloom.functions.text import seeded_hash, strip


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed scan; blank lines are skipped, a broken line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("allowSingleQuotes", "false").json(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_jsonl``; a path that does not exist is an empty table."""
    try:
        return read_jsonl(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_numbered_lines(spark: SparkSession, path) -> DataFrame:
    """Lines as ``(file, line_no, raw)``. Blank lines take a number and are left out.

    A text scan reads the lines of one file block in order inside one task, so ids
    that grow within a task number a block's lines once its smallest id is known.
    A block's start comes from the line counts of the blocks before it. Blocks are named by
    two numbers, a hash of the file and the block's first byte, so their table is a
    few bytes a block, and its measured size decides how it is joined.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("raw"),
    )
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("_file", "_block")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
        .withColumn("_offset", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
        .drop("_lines")
    )
    return (
        lines.filter(F.length(strip(F.col("raw"))) > 0)
        .join(blocks, ["_file", "_block"])
        .select("file", (F.col("_id") - F.col("_first") + F.col("_offset") + 1).alias("line_no"), "raw")
    )


def holdout_items(chat: DataFrame) -> DataFrame:
    m = lambda i: F.get("messages", F.lit(i))["content"]
    keep = [c for c in chat.columns if c != "messages"]
    return chat.select(*keep, m(1).alias("user"), m(2).alias("expected"), F.lit(HOLDOUT).alias("kind"))


def adversarial_items(rows: DataFrame) -> DataFrame:
    keep = [c for c in rows.columns if c not in ("text", "label", "kind")]
    return rows.select(
        *keep,
        F.col("text").alias("user"),
        F.col("label").alias("expected"),
        F.concat(F.lit(ADVERSARIAL_PREFIX), F.coalesce("kind", F.lit("unknown"))).alias("kind"),
    )


def load_items(spark: SparkSession, folder: str, include_adversarial: bool = True) -> DataFrame:
    """Evaluation items of a folder: ``eval.jsonl`` and, if there, ``adversarial.jsonl``."""
    items = holdout_items(read_jsonl(spark, f"{folder}/eval.jsonl", CHAT_SCHEMA))
    if not include_adversarial:
        return items
    extra = adversarial_items(read_optional(spark, f"{folder}/adversarial.jsonl", ADVERSARIAL_SCHEMA))
    return items.unionByName(extra, allowMissingColumns=True).select("user", "expected", "kind")


def load_rich_items(spark: SparkSession, folder: str) -> DataFrame:
    return read_jsonl(spark, f"{folder}/rich_eval.jsonl", RICH_SCHEMA)


def chat_line() -> F.Column:
    return F.to_json(F.struct("messages"))


def export_lines(split: DataFrame, key: str, seed: int = 43) -> DataFrame:
    """Chat rows as ``(split, line)`` in a seeded order. The sort is by range, so
    it spreads over the cluster whatever the class or split sizes."""
    return (
        split.select("split", seeded_hash(seed, F.col(key)).alias("_h"), F.col(key).alias("_k"), chat_line().alias("line"))
        .orderBy("split", "_h", "_k")
        .select("split", "line")
    )


def write_jsonl(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8 text files under ``split=<name>``; as many files as there are tasks."""
    lines.write.mode(mode).partitionBy("split").text(path)


def export_manifest(lines: DataFrame) -> DataFrame:
    """Lines and bytes, newline included, of each split."""
    return lines.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("line") + 1).alias("n_bytes")
    )


def require_splits(manifest: DataFrame, needed=("train", "eval")) -> DataFrame:
    """Fail the job if a split has no line."""
    have = F.array(*[F.count_if(F.col("split") == s) for s in needed])
    check = manifest.agg(F.array_min(have).alias("least"))
    ok = check.select((F.col("least") > 0).alias("ok")).scalar()
    return manifest.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("a split is missing")).cast("boolean")))
