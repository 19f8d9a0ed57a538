"""Comparing two runs request by request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replyloom.functions.numeric import half_even, ratio
from replyloom.functions.text import preview
from replyloom.operators.common import is_holdout, long_form
from replyloom.operators.skew import lookup_counted

KEY = "request_id"


def last_per_text(results: DataFrame, position: str, text: str = "user") -> DataFrame:
    """Runs keyed by request text: of a repeated text only the last row counts."""
    rest = [c for c in results.columns if c != text]
    best = results.groupBy(text).agg(F.max_by(F.struct(*rest), F.col(position)).alias("_r"))
    return best.select(text, "_r.*").select(*results.columns)


def run_join(left: DataFrame, right: DataFrame, on: str = KEY, how: str = "inner") -> DataFrame:
    """Left rows with the other run's final label, correctness and a match flag."""
    other = right.select(
        on,
        F.col("final_label").alias("other_label"),
        F.col("correct").alias("other_correct"),
        F.lit(True).alias("matched"),
    )
    return left.join(other, on, how)


def rescued_broken(router: DataFrame, cheap: DataFrame, on: str = KEY) -> DataFrame:
    """Holdout requests whose escalation turned a wrong answer right or a right one
    wrong."""
    esc = router.filter(is_holdout() & (F.col("route") == "escalated"))
    both = run_join(esc, cheap, on).filter(F.col("correct") != F.col("other_correct"))
    return both.select(
        "request_id",
        F.when(F.col("correct"), F.lit("rescued")).otherwise(F.lit("broken")).alias("outcome"),
        "expected",
        F.col("other_label").alias("cheap_label"),
        "final_label",
        preview(F.col("user"), 60).alias("preview"),
    )


def run_agreement(run: DataFrame, other: DataFrame, on: str = KEY) -> DataFrame:
    """Share of all rows of ``run`` with the same final label; unmatched disagree."""
    same = F.coalesce(F.col("matched"), F.lit(False)) & F.col("final_label").eqNullSafe(F.col("other_label"))
    return (
        run_join(run, other, on, "left")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(same).alias("same"))
        .withColumn("agreement", half_even(ratio(F.col("same"), F.col("total"))))
    )


def run_stability(first: DataFrame, second: DataFrame, on: str = KEY) -> DataFrame:
    """Two runs of the same model: requests in both and how many kept their answer."""
    same = F.col("final_label").eqNullSafe(F.col("other_label"))
    return (
        run_join(first, second, on)
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(same).alias("same"))
        .withColumn("stable", F.col("total") == F.col("same"))
    )


def outcome(a: Column, b: Column) -> Column:
    return (
        F.when(a & b, F.lit("both")).when(a, F.lit("first_only")).when(b, F.lit("second_only")).otherwise(F.lit("neither"))
    )


def outcome_matrix(first: DataFrame, second: DataFrame, on: str = KEY) -> DataFrame:
    """Both right, one only, neither; requests missing from a side are counted."""
    b = second.select(on, F.col("correct").alias("_b"))
    one = first.select(on, F.col("correct").alias("_a")).join(b, on, "full_outer").agg(
        *[
            F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (outcome(F.col("_a"), F.col("_b")) == o)).alias(o)
            for o in ("both", "first_only", "second_only", "neither")
        ],
        F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("unmatched"),
    )
    names = ("both", "first_only", "second_only", "neither", "unmatched")
    return long_form(one, [], [[("outcome", F.lit(n)), ("n", F.col(n))] for n in names])


def outcome_examples(first: DataFrame, second: DataFrame, k: int = 5, on: str = KEY) -> DataFrame:
    """The first ``k`` requests of each outcome. A rank bound this small is applied
    before the shuffle, so no outcome's rows gather in one task."""
    joined = run_join(first, second, on).withColumn("outcome", outcome(F.col("correct"), F.col("other_correct")))
    ranked = joined.withColumn("rank", F.row_number().over(W.partitionBy("outcome").orderBy("request_id")))
    return ranked.filter(F.col("rank") <= k).select(
        "outcome", "rank", "request_id", "expected", "final_label", "other_label", preview(F.col("user"), 80).alias("preview")
    )


def run_join_by_text(left: DataFrame, right: DataFrame, text: str = "user") -> DataFrame:
    """Join on the request text against a run with one row per text; a NULL text matches
    nothing. Texts repeat on
    the left, one of them perhaps a third of all rows: their counts settle which
    keys are broadcast and which are shuffled."""
    other = right.select(
        text, F.col("final_label").alias("other_label"), F.col("correct").alias("other_correct"), F.lit(True).alias("matched")
    )
    left, other = left.filter(F.col(text).isNotNull()), other.filter(F.col(text).isNotNull())
    counted = left.groupBy(text).agg(F.count(F.lit(1)).alias("_copies"))
    return lookup_counted(left, other.join(counted, text), [text], "_copies", F.col(KEY)).drop("_copies")
