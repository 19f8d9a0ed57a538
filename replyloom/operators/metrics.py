"""Quality of one run: accuracy, format, coverage, confusion, slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import INTENTS
from replyloom.functions.numeric import half_even, ratio, share
from replyloom.functions.text import in_domain, normalize_reply, strict_format
from replyloom.operators.common import counted, long_form, right


def score_plain(requests: DataFrame, replies: DataFrame, raw: str = "raw", classes=INTENTS) -> DataFrame:
    """Evaluate one-word replies: normalised label, strict format flag, correctness. A request
    without a reply has no label, a bad format and a wrong answer."""
    joined = requests.join(replies.select("request_id", raw), "request_id", "left")
    return joined.select(
        *requests.columns,
        F.col(raw).alias("raw_reply"),
        normalize_reply(F.col(raw)).alias("final_label"),
        strict_format(F.col(raw), classes).alias("format_ok"),
        F.coalesce(normalize_reply(F.col(raw)) == F.col("expected"), F.lit(False)).alias("correct"),
    )


def constant_reply(requests: DataFrame, label: str) -> DataFrame:
    """A run whose every reply is ``label``: the plumbing check."""
    return requests.select("request_id", F.lit(label).alias("raw"))


def majority_class(df: DataFrame, label: str = "label", classes=INTENTS) -> DataFrame:
    """The most frequent class, one row; ties to the earlier class."""
    one = df.agg(*[F.count_if(F.col(label) == c).alias(c) for c in classes])
    ranked = F.array(
        *[F.struct(F.col(c).alias("n"), F.lit(-i).alias("o"), F.lit(c).alias("label")) for i, c in enumerate(classes)]
    )
    return one.select(F.array_max(ranked).alias("top")).select("top.label", "top.n")


def accuracy(results: DataFrame, by: list[str] = [], correct: str = "correct") -> DataFrame:
    return counted(
        by,
        results,
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(correct)).alias("n_correct"),
        half_even(share(F.col(correct))).alias("accuracy"),
    )


def accuracy_and_format(results: DataFrame, by: list[str] = []) -> DataFrame:
    return counted(
        by,
        results,
        F.count(F.lit(1)).alias("total"),
        F.count_if("correct").alias("n_correct"),
        half_even(share(F.col("correct"))).alias("accuracy"),
        F.count_if("format_ok").alias("n_strict"),
        half_even(share(F.col("format_ok"))).alias("strict_ratio"),
    )


def filtered_accuracy(results: DataFrame, keep: Column, pred: str = "final_label") -> DataFrame:
    return results.agg(F.count_if(keep & right(pred)).alias("n_correct"), F.count_if(keep).alias("total"))


def per_class_accuracy(
    results: DataFrame, by: list[str] = [], correct: str = "correct", classes=INTENTS
) -> DataFrame:
    """Right, total and accuracy of each class; a class without rows is kept with a
    NULL accuracy. Conditional aggregates fill the domain without a join."""
    of = F.col("expected")
    aggs = []
    for i, c in enumerate(classes):
        aggs += [
            F.count_if(of == c).alias(f"t{i}"),
            F.count_if((of == c) & F.col(correct)).alias(f"c{i}"),
        ]
    return long_form(
        counted(by, results, *aggs),
        by,
        [
            [
                ("label", F.lit(c)),
                ("n_correct", F.col(f"c{i}")),
                ("total", F.col(f"t{i}")),
                ("accuracy", half_even(ratio(F.col(f"c{i}"), F.col(f"t{i}"), None))),
            ]
            for i, c in enumerate(classes)
        ],
    )


def class_coverage(results: DataFrame, by: list[str] = [], pred: str = "final_label", classes=INTENTS) -> DataFrame:
    """Which classes are ever predicted, sorted, and how many."""
    valid = F.when(in_domain(F.col(pred), classes), F.col(pred))
    out = counted(by, results, F.array_sort(F.collect_set(valid)).alias("present"))
    return out.select(*by, F.array_join("present", ",").alias("classes_present"), F.size("present").alias("n_present"))


def confusion_matrix(results: DataFrame, by: list[str] = [], pred: str = "final_label") -> DataFrame:
    return results.groupBy(*by, "expected", F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def confused_pairs(results: DataFrame, by: list[str] = [], pred: str = "final_label") -> DataFrame:
    return confusion_matrix(results, by, pred).filter(~F.col("expected").eqNullSafe(F.col("predicted")))


# The style slices' definitions.
SHORT_BELOW = 30
CODE_PATTERN = r"`|\(\)|[a-z]+_[a-z0-9]+|[a-z][A-Z]"
RUDE_PATTERN = r"(?i)\b(damn|hell|crap|wtf|stupid)\b"


def style_slices(
    results: DataFrame, text: str = "user", code: str = CODE_PATTERN, rude: str = RUDE_PATTERN
) -> DataFrame:
    """Accuracy on short, code-bearing and rude requests; a request may be in
    several slices, all counted in one pass."""
    t = F.col(text)
    slices = {
        "all": F.lit(True),
        "short": F.length(t) < SHORT_BELOW,
        "code": t.rlike(code),
        "rude": t.rlike(rude),
    }
    one = results.agg(
        *[F.count_if(c).alias(f"t_{n}") for n, c in slices.items()],
        *[F.count_if(c & F.col("correct")).alias(f"c_{n}") for n, c in slices.items()],
    )
    return long_form(
        one,
        [],
        [
            [
                ("slice", F.lit(n)),
                ("total", F.col(f"t_{n}")),
                ("n_correct", F.col(f"c_{n}")),
                ("accuracy", half_even(ratio(F.col(f"c_{n}"), F.col(f"t_{n}"), None))),
            ]
            for n in slices
        ],
    )


def release_gate(
    candidate: DataFrame,
    base: DataFrame,
    stability: DataFrame,
    *,
    gain: float = 0.10,
    class_floor: float = 0.50,
    min_classes: int = 3,
    classes=INTENTS,
) -> DataFrame:
    """All five release criteria of a candidate run against a base run; the
    ``stability`` input is ``run_stability``'s one row."""
    of = F.col("expected")
    cand = candidate.agg(
        share(F.col("correct")).alias("accuracy"),
        share(F.col("format_ok")).alias("strict"),
        F.array_min(
            F.array(
                *[
                    ratio(F.count_if((of == c) & F.col("correct")), F.count_if(of == c), None)
                    for c in classes
                ]
            )
        ).alias("worst_class"),
        sum((F.count_if(F.col("final_label") == c) > 0).cast("int") for c in classes).alias("n_present"),
    )
    base_accuracy = base.agg(share(F.col("correct"))).scalar()
    stable = stability.agg(F.bool_and(F.col("total") == F.col("same"))).scalar()
    checks = {
        "accuracy_ok": half_even(F.col("accuracy") - F.col("base_accuracy"), 9) >= gain,
        "classes_ok": F.col("worst_class") >= class_floor,
        "format_ok": F.col("strict") >= 1.0,
        "stable_ok": F.col("stable"),
        "coverage_ok": F.col("n_present") >= min_classes,
    }
    verdict = F.lit(True)
    for c in checks.values():
        verdict = verdict & F.coalesce(c, F.lit(False))
    cand = cand.withColumns({"base_accuracy": base_accuracy, "stable": stable})
    return cand.select(
        half_even(F.col("accuracy")).alias("accuracy"),
        half_even(F.col("base_accuracy")).alias("base_accuracy"),
        half_even(F.col("worst_class")).alias("worst_class"),
        half_even(F.col("strict")).alias("strict_ratio"),
        "n_present",
        *[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()],
        verdict.alias("released"),
    )
