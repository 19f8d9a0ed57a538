"""Small building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import ADVERSARIAL_PREFIX, HOLDOUT


def is_holdout(kind: Column | None = None) -> Column:
    return (F.col("kind") if kind is None else kind) == HOLDOUT


def is_adversarial(kind: Column | None = None) -> Column:
    return (F.col("kind") if kind is None else kind).startswith(ADVERSARIAL_PREFIX)


def right(pred: str | Column = "final_label", expected: str | Column = "expected") -> Column:
    """Prediction equals gold; a NULL prediction is wrong, not unknown."""
    pred = F.col(pred) if isinstance(pred, str) else pred
    expected = F.col(expected) if isinstance(expected, str) else expected
    return F.coalesce(pred == expected, F.lit(False))


def long_form(df: DataFrame, keep: list[str], rows: list[list[tuple[str, Column]]]) -> DataFrame:
    """Turn columns of each row into several rows; ``rows`` lists (name, value)."""
    packed = F.array(*[F.struct(*[v.alias(n) for n, v in row]) for row in rows])
    return df.select(*keep, F.inline(packed))


def counted(by: list[str], df: DataFrame, *aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
