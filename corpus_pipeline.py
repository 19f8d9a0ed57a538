"""The corpus pipeline: five stages from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from replyloom.llm import decontaminate, jaccard, packing, pii, quality
from replyloom.llm.common import table
from replyloom.session import cut_lineage


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a fair grade or better reaches one half."""
    return quality.select(docs, quality.fit(docs, quality.graded(table(spark, sf_dir, "labels"))))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on five-word shingles."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; mostly contaminated documents go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths."""
    return packing.pack(docs)


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", uncontaminated),
    ("personal_data", redacted),
    ("packing", packed),
]

#: Fitted weights, similarity search and tokenizer cannot be written in SQL; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
