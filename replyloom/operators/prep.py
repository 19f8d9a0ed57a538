"""Building a labelled chat data set: merge, guard, clean, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import INTENTS, ROLES, USER_LENGTH
from replyloom.functions.numeric import half_even, ratio
from replyloom.functions.text import fingerprint, in_domain, strip
from replyloom.operators.common import long_form

SYSTEM_PROMPT = "Answer with one class: " + ", ".join(INTENTS) + "."


def merge_pairs(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Bag union that remembers where each pair came from."""
    tag = lambda df, name: df if "origin" in df.columns else df.withColumn("origin", F.lit(name))
    return tag(real, "real").unionByName(tag(synthetic, "synth"), allowMissingColumns=True)


def bad_labels(pairs: DataFrame, classes=INTENTS) -> DataFrame:
    return pairs.filter(~in_domain(F.col("label"), classes))


def good_labels(pairs: DataFrame, classes=INTENTS, strict: bool = False) -> DataFrame:
    """Rows inside the class domain; ``strict`` fails the job on any other row."""
    if not strict:
        return pairs.filter(in_domain(F.col("label"), classes))
    checked = F.when(in_domain(F.col("label"), classes), F.col("label")).otherwise(
        F.raise_error(F.concat(F.lit("label outside the domain: "), F.coalesce("label", F.lit("NULL"))))
    )
    return pairs.withColumn("label", checked)


def chat_messages(text: Column, label: Column, system_prompt: str = SYSTEM_PROMPT) -> Column:
    contents = (F.lit(system_prompt), text, label)
    return F.array(
        *[
            F.struct(F.lit(role).alias("role"), content.alias("content"))
            for role, content in zip(ROLES, contents)
        ]
    )


def to_chat(pairs: DataFrame, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    return pairs.withColumn("messages", chat_messages(F.col("text"), F.col("label"), system_prompt))


def label_of(messages: str = "messages") -> Column:
    return F.get(F.col(messages), F.lit(2))["content"]


def class_distribution(
    df: DataFrame, label: str = "label", split: str | None = None, parts=("train", "eval"), classes=INTENTS
) -> DataFrame:
    """Rows per class, one column per split part when ``split`` is given. Every
    class appears, and all parts come out of one pass."""
    of = F.col(label)
    counts = [(c, F.count_if(of == c)) for c in classes]
    if split is None:
        one = df.agg(*[n.alias(f"n_{i}") for i, (_, n) in enumerate(counts)])
        return long_form(
            one, [], [[("label", F.lit(c)), ("n", F.col(f"n_{i}"))] for i, c in enumerate(classes)]
        )
    at = F.col(split)
    one = df.agg(
        *[
            F.count_if((of == c) & (at == p)).alias(f"n_{i}_{p}")
            for i, c in enumerate(classes)
            for p in parts
        ]
    )
    return long_form(
        one,
        [],
        [
            [("label", F.lit(c))] + [(p, F.col(f"n_{i}_{p}")) for p in parts]
            for i, c in enumerate(classes)
        ],
    )


def clean_pairs(pairs: DataFrame, key: str, bounds: tuple[int, int] = USER_LENGTH) -> DataFrame:
    """Drop empty, too short, too long and repeated texts; the lowest ``key`` of a
    repeat stays. Repeats are found on (fingerprint, key) alone, folded before the
    shuffle, and rows are then picked by their unique key: a hot text skews neither."""
    n = F.length("text")
    kept = pairs.filter((F.length(strip(F.col("text"))) > 0) & n.between(*bounds))
    first = kept.groupBy(fingerprint(F.col("text")).alias("_fp")).agg(F.min(key).alias(key))
    return kept.join(first.select(key), key, "left_semi")


def dataset_rules(pairs: DataFrame, min_rows: int = 50, min_real: float = 0.2, classes=INTENTS) -> DataFrame:
    """Size, real share and class balance of a data set with their verdicts."""
    one = pairs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("origin") == "real").alias("n_real"),
        *[F.count_if(F.col("label") == c).alias(f"_c{i}") for i, c in enumerate(classes)],
    )
    per = F.array(*[F.col(f"_c{i}") for i in range(len(classes))])
    return one.select(
        "n_rows",
        "n_real",
        half_even(ratio(F.col("n_real"), F.col("n_rows"))).alias("real_share"),
        F.array_min(per).alias("smallest_class"),
        F.array_max(per).alias("largest_class"),
        (F.col("n_rows") >= min_rows).alias("size_ok"),
        (ratio(F.col("n_real"), F.col("n_rows")) >= min_real).alias("real_ok"),
        (F.array_min(per) * 2 >= F.array_max(per)).alias("balance_ok"),
    )


def balance_topup(pairs: DataFrame, classes=INTENTS) -> DataFrame:
    """How many rows each class lacks to reach the largest class."""
    dist = class_distribution(pairs, classes=classes)
    largest = dist.agg(F.max("n")).scalar()
    return dist.select("label", "n", (largest - F.col("n")).alias("missing"))


def class_support(df: DataFrame, label: str = "label", at_least: int = 5, classes=INTENTS) -> DataFrame:
    return class_distribution(df, label, classes=classes).withColumn("enough", F.col("n") >= at_least)


def candidate_triage(candidates: DataFrame, classes=INTENTS) -> DataFrame:
    """Candidates per class and annotator confidence; high ones can be labelled
    as they are, the rest need a look."""
    high = F.col("conf") == "high"
    return (
        candidates.filter(in_domain(F.col("agent_class"), classes))
        .groupBy(F.col("agent_class").alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(high).alias("take"),
            F.count_if(~F.coalesce(high, F.lit(False))).alias("review"),
        )
    )


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    at = F.col(split)
    return df.agg(
        F.count_if(at == "train").alias("n_train"),
        F.count_if(at == "eval").alias("n_eval"),
        half_even(ratio(F.count_if(at == "eval"), F.count(F.lit(1)))).alias("eval_ratio"),
    )
