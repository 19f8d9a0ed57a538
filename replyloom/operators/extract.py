"""Six-field extraction from one reply or from four staged replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import RICH_FIELDS
from replyloom.functions.numeric import half_even, ratio
from replyloom.functions.text import JSON_WHITESPACE
from replyloom.functions.replies import is_text_field, rich_struct, target_name, with_object
from replyloom.functions.text import preview
from replyloom.operators.common import counted, long_form
from replyloom.operators.route import with_cost

_FIELDS = ",".join(f"{n}:string" for n in RICH_FIELDS)


def _named(obj: str, raw: str = "raw") -> Column:
    text = F.col(f"{obj}.target_name")
    return target_name(text, is_text_field(F.col(raw), text, "target_name"))


def extract_mono(replies: DataFrame) -> DataFrame:
    """One reply per request. An unreadable reply yields every default, as the
    published rule does, and says so in ``parse_error``."""
    df = with_cost(with_object(replies, "raw", _FIELDS, "_o"))
    o = lambda n: F.col(f"_o.{n}")
    return df.select(
        "request_id",
        rich_struct(
            o("primary_intent"), o("secondary_intent"), o("target_type"), _named("_o"), o("urgency"), o("negation")
        ).alias("predicted"),
        F.col("_o").isNull().cast("int").alias("parse_errors"),
        F.lit(1).cast("bigint").alias("n_calls"),
        F.col("cost").alias("total_cost"),
        F.col("latency_ms").alias("total_latency_ms"),
        F.col("latency_ms").alias("wall_latency_ms"),
        "input_tokens",
        "output_tokens",
    )


# which stage is trusted with which fields
STAGE_FIELDS = {
    "classify": ("primary_intent", "secondary_intent"),
    "target": ("target_type", "target_name"),
    "sentiment": ("urgency", "negation"),
}


def extract_multi(replies: DataFrame) -> DataFrame:
    """Four staged replies per request folded by one grouping. Each reply is read
    first, so only short fields are shuffled. Stages 2 to 4 run side by side: the
    wall latency is the first stage plus the slowest of them."""
    df = with_cost(with_object(replies, "raw", _FIELDS, "_o"))
    stage = F.col("stage")
    df = df.withColumn("_name", F.when(stage == "target", _named("_o")))
    owner = {f: s for s, fields in STAGE_FIELDS.items() for f in fields}
    take = lambda f: F.max(
        F.when(stage == owner[f], F.col("_name") if f == "target_name" else F.col(f"_o.{f}"))
    ).alias(f)
    lat = F.col("latency_ms")
    grouped = df.groupBy("request_id").agg(
        *[take(f) for f in RICH_FIELDS],
        F.sum(F.col("_o").isNull().cast("int")).alias("parse_errors"),
        F.count(F.lit(1)).alias("n_calls"),
        F.sum("cost").alias("total_cost"),
        F.sum(lat).alias("total_latency_ms"),
        (F.max(F.when(stage == "normalize", lat)) + F.max(F.when(stage != "normalize", lat))).alias("wall_latency_ms"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    )
    c = F.col
    return grouped.select(
        "request_id",
        rich_struct(
            c("primary_intent"), c("secondary_intent"), c("target_type"), c("target_name"), c("urgency"), c("negation")
        ).alias("predicted"),
        c("parse_errors").cast("int").alias("parse_errors"),
        "n_calls",
        "total_cost",
        "total_latency_ms",
        "wall_latency_ms",
        "input_tokens",
        "output_tokens",
    )


def stage_inputs(requests: DataFrame, replies: DataFrame, text: str = "user") -> DataFrame:
    """What stages 2 to 4 are asked: the request and the first stage's feature object as it
    is, whatever its keys; an unreadable or missing first stage contributes an empty object."""
    first = with_object(
        replies.filter(F.col("stage") == "normalize"),
        "raw",
        "verbs:array<string>,nouns:array<string>,tone:string,language:string",
        "_n",
    ).select("request_id", F.when(F.col("_n").isNotNull(), F.btrim("raw", F.lit(JSON_WHITESPACE))).alias("_n"))
    joined = requests.select("request_id", text).join(first, "request_id", "left")
    return joined.select(
        "request_id",
        F.concat(
            F.lit("REQUEST: "), F.col(text), F.lit("\nFEATURES: "), F.coalesce("_n", F.lit("{}"))
        ).alias("stage_input"),
    )


def field_match(predicted: str = "predicted", expected: str = "expected") -> Column:
    """Struct of six booleans; target names compare without case and NULL is ''. Without an
    extraction no field matches."""
    p, e = F.col(predicted), F.col(expected)
    there = p.isNotNull()
    flat = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return F.struct(
        *[
            (there & (flat(p[f]) == flat(e[f]) if f == "target_name" else p[f].eqNullSafe(e[f]))).alias(f)
            for f in RICH_FIELDS
        ]
    )


def all_match(match: str = "field_match") -> Column:
    out = F.lit(True)
    for f in RICH_FIELDS:
        out = out & F.col(f"{match}.{f}")
    return out


def failing_fields(match: str = "field_match") -> Column:
    """Names of the fields that miss, comma separated, in field order."""
    return F.array_join(
        F.array_compact(F.array(*[F.when(~F.col(f"{match}.{f}"), F.lit(f)) for f in RICH_FIELDS])), ","
    )


def score_extraction(items: DataFrame, extracted: DataFrame) -> DataFrame:
    """Items ``(request_id, user, expected STRUCT)`` with predictions compared; an item
    without an extraction has none and misses every field."""
    df = items.join(extracted, "request_id", "left").withColumn("field_match", field_match())
    return df.withColumn("correct", all_match())


def field_accuracy(scored: DataFrame, by: list[str] = []) -> DataFrame:
    one = counted(
        by,
        scored,
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(f"field_match.{f}")).alias(f) for f in RICH_FIELDS],
        F.count_if("correct").alias("composite"),
    )
    return long_form(
        one,
        by,
        [
            [
                ("field", F.lit(f)),
                ("n_correct", F.col(f)),
                ("total", F.col("total")),
                ("rate", half_even(ratio(F.col(f), F.col("total")), 4)),
            ]
            for f in (*RICH_FIELDS, "composite")
        ],
    )


def field_delta(accuracy: DataFrame, first: str, second: str) -> DataFrame:
    """Percentage points between two runs of a ``field_accuracy(by=run_id)`` table."""
    rate = lambda run: F.max(F.when(F.col("run_id") == run, F.col("rate")))
    return accuracy.groupBy("field").agg(
        rate(first).alias("first_rate"),
        rate(second).alias("second_rate"),
        half_even((rate(second) - rate(first)) * 100, 4).alias("delta_pp"),
    )


def field_errors(scored: DataFrame) -> DataFrame:
    one = scored.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(~F.col(f"field_match.{f}")).alias(f) for f in RICH_FIELDS],
    )
    return long_form(one, ["total"], [[("field", F.lit(f)), ("n_errors", F.col(f))] for f in RICH_FIELDS])


def token_usage(replies: DataFrame, base_run: str) -> DataFrame:
    """Tokens in, out and together per run, with ratios to ``base_run``. The
    number of rows left after grouping is the number of runs."""
    per = replies.groupBy("run_id").agg(
        F.sum("input_tokens").alias("tokens_in"), F.sum("output_tokens").alias("tokens_out")
    )
    base = per.filter(F.col("run_id") == base_run)
    of = lambda c: base.agg(F.max(c)).scalar()
    return per.select(
        "run_id",
        "tokens_in",
        "tokens_out",
        (F.col("tokens_in") + F.col("tokens_out")).alias("tokens_total"),
        half_even(ratio(F.col("tokens_in"), of("tokens_in"), None)).alias("in_ratio"),
        half_even(ratio(F.col("tokens_out"), of("tokens_out"), None)).alias("out_ratio"),
    )


def mode_disagreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """Requests where only one mode has all fields right, with what the other missed."""
    a = first.select("request_id", "user", F.col("correct").alias("a"), failing_fields().alias("fa"))
    b = second.select("request_id", F.col("correct").alias("b"), failing_fields().alias("fb"))
    return a.join(b, "request_id").filter(F.col("a") != F.col("b")).select(
        "request_id",
        F.when(F.col("a"), F.lit("first_only")).otherwise(F.lit("second_only")).alias("outcome"),
        F.when(F.col("a"), F.col("fb")).otherwise(F.col("fa")).alias("missed"),
        preview(F.col("user"), 60).alias("preview"),
    )


def mode_vote(first: DataFrame, second: DataFrame) -> DataFrame:
    """Accept where both modes give the same six fields, else review; without either
    extraction, review."""
    b = second.select("request_id", F.col("predicted").alias("_p"))
    same = F.col("predicted").isNotNull() & F.col("_p").isNotNull()
    for f in RICH_FIELDS:
        same = same & F.col(f"predicted.{f}").eqNullSafe(F.col(f"_p.{f}"))
    return (
        first.join(b, "request_id")
        .groupBy(F.when(same, F.lit("accept")).otherwise(F.lit("review")).alias("verdict"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("correct").alias("first_right"),
            half_even(ratio(F.count_if("correct"), F.count(F.lit(1)))).alias("first_accuracy"),
        )
    )


def hybrid_fields(first: DataFrame, second: DataFrame, from_second=("target_type", "target_name")) -> DataFrame:
    """Prediction made of chosen fields of each mode, scored again."""
    b = second.select("request_id", F.col("predicted").alias("_p"))
    mixed = F.struct(
        *[(F.col(f"_p.{f}") if f in from_second else F.col(f"predicted.{f}")).alias(f) for f in RICH_FIELDS]
    )
    df = first.select("request_id", "user", "expected", "predicted").join(b, "request_id")
    df = df.withColumn("predicted", mixed).drop("_p").withColumn("field_match", field_match())
    return df.withColumn("correct", all_match())


def target_hallucination(scored: DataFrame) -> DataFrame:
    """Target names that do not occur in their request text, predicted and gold."""
    text = F.lower("user")
    absent = lambda c: F.coalesce(~F.contains(text, F.lower(c)), F.lit(False))
    p, e = F.col("predicted.target_name"), F.col("expected.target_name")
    return scored.agg(
        F.count_if(p.isNotNull()).alias("named"),
        F.count_if(absent(p)).alias("invented"),
        F.count_if(e.isNotNull()).alias("gold_named"),
        F.count_if(absent(e)).alias("gold_absent"),
    )
