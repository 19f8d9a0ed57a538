"""Closed value sets, table schemas and price list shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the published task definition. -----------
INTENTS = ("search", "understand", "describe", "modify")
SECONDARY_INTENTS = INTENTS + ("none",)
TARGET_TYPES = (
    "file", "function", "module", "project", "feature", "bug", "config", "test", "other",
)
URGENCIES = ("low", "normal", "high")
STATUSES = ("OK", "UNSURE", "FAIL")
ROLES = ("system", "user", "assistant")
RICH_FIELDS = (
    "primary_intent", "secondary_intent", "target_type", "target_name", "urgency", "negation",
)
RICH_DEFAULTS = {
    "primary_intent": "modify",
    "secondary_intent": "none",
    "target_type": "other",
    "urgency": "normal",
}
STAGES = ("normalize", "classify", "target", "sentiment")
# USD per million tokens, input and output.
PRICES = {
    "gpt-4o-mini": (0.150, 0.600),
    "gpt-4o": (2.50, 10.00),
    "text-embedding-3-small": (0.020, 0.0),
}
SMALL_MODEL, LARGE_MODEL, EMBED_MODEL = "gpt-4o-mini", "gpt-4o", "text-embedding-3-small"
ACCEPT_AT, REJECT_BELOW = 0.85, 0.5  # gate thresholds
ESCALATE_BELOW = 0.85  # cheap-to-strong routing
STAY_AT = 0.6  # small-model-first routing
USER_LENGTH = (5, 500)
EVAL_RATIO = 0.2
SEED = 42
# -----------------------------------------------------------------------------

# Fixed values as well: field names and order of the published file formats.

HOLDOUT = "holdout"
ADVERSARIAL_PREFIX = "adv-"
OUT_OF_DOMAIN = "FAIL"

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
PAIR_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("text", "label", "origin", "lang")]
)
CHAT_SCHEMA = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])
ADVERSARIAL_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("text", "label", "kind", "lang")]
)
CANDIDATE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("text", "source", "agent_class", "conf")]
)
RICH_SCHEMA = T.StructType(
    [T.StructField("text", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in RICH_FIELDS[:-1]]
    + [T.StructField("negation", T.BooleanType())]
)
CALL = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("raw", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
    ]
)
REPLY_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("call_no", T.IntegerType()),
        T.StructField("raw", T.StringType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
    ]
)
ROUTED_ROW = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("expected", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("final_label", T.StringType()),
        T.StructField("final_confidence", T.DoubleType()),
        T.StructField("cheap_label", T.StringType()),
        T.StructField("cheap_confidence", T.DoubleType()),
        T.StructField("calls", T.ArrayType(CALL)),
        T.StructField("total_cost", T.DoubleType()),
        T.StructField("total_latency_ms", T.DoubleType()),
    ]
)
BASELINE_ROW = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("expected", T.StringType()),
        T.StructField("raw_reply", T.StringType()),
        T.StructField("normalized", T.StringType()),
        T.StructField("format_ok", T.BooleanType()),
        T.StructField("correct", T.BooleanType()),
    ]
)
