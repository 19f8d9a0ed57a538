"""Strict parsing of recorded model replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import (
    INTENTS, RICH_DEFAULTS, SECONDARY_INTENTS, TARGET_TYPES, URGENCIES,
)
from replyloom.functions.settle import settle
from replyloom.functions.text import JSON_WHITESPACE, in_domain, normalize_reply, strip

_STRICT = {"allowSingleQuotes": "false"}
_NUMBER = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
_NOT_FINITE = r'(?i)^"?[+-]?(nan|inf|infinity)"?$'


def _object_column(raw: Column, fields: str) -> Column:
    """Parse one JSON object with nothing after it.

    ``from_json`` forgives trailing text. Putting the body in front of a marker
    element closes that hole: anything but exactly one object before the marker
    changes the array's size or fails to parse.
    """
    body = F.btrim(F.coalesce(F.nullif(raw, F.lit("")), F.lit("{}")), F.lit(JSON_WHITESPACE))
    items = F.from_json(
        F.concat(F.lit("["), body, F.lit(',{"tail_mark":"1"}]')),
        f"array<struct<{fields},tail_mark:string>>",
        _STRICT,
    )
    return F.when(body.startswith("{") & body.endswith("}"), items)


def _whole(items: Column) -> Column:
    return (
        (F.size(items) == 2)
        & F.get(items, F.lit(0)).isNotNull()
        & (F.get(items, F.lit(1))["tail_mark"] == "1")
    )


def with_object(df: DataFrame, raw: str | Column, fields: str, out: str, when=None) -> DataFrame:
    """Add struct ``out`` with ``fields``, NULL when ``raw`` is no lone JSON object."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    items = _object_column(raw, fields)
    if when is not None:
        items = F.when(when, items)
    tmp = f"_{out}_items"
    names = [f.split(":")[0] for f in fields.split(",")]
    first = F.get(F.col(tmp), F.lit(0))
    found = F.when(_whole(F.col(tmp)), F.struct(*[first[n].alias(n) for n in names]))
    return settle(df.withColumn(tmp, items), {out: found}, drop=(tmp,))


def _is_json_boolean(raw: Column) -> Column:
    """Tell ``true`` from ``"true"``: a boolean-typed parse takes only the former."""
    return F.from_json(raw, "struct<confidence:boolean>", _STRICT)["confidence"].isNotNull()


def with_reply(
    df: DataFrame,
    raw: str = "raw",
    *,
    strict: bool = False,
    clamp: bool = False,
    classes=INTENTS,
    when: Column | None = None,
) -> DataFrame:
    """Add ``label``, ``confidence``, ``parse_error`` from a JSON reply column.

    NaN and infinities become a NULL confidence: every comparison with them then
    fails, as it must. ``strict`` is the fallback tier's reading: no punctuation
    strip, an unusable confidence voids the reply, and a label outside the domain
    is NULL.
    """
    src = F.col(raw)
    df = with_object(df, raw, "label:string,confidence:string", "_obj", when)
    text = F.col("_obj.confidence")
    trimmed = strip(text)
    usable = (
        F.when(F.col("_obj").isNull(), F.lit("bad"))
        .when(
            text.isNull(),
            F.when(
                F.lit(strict) & F.array_contains(F.json_object_keys(src), "confidence"), F.lit("bad")
            ).otherwise(F.lit("zero")),
        )
        .when(text.rlike(r"^[\[{]"), F.lit("bad" if strict else "zero"))
        .when(
            text.isin("true", "false"),
            F.when(_is_json_boolean(src), F.lit("bool")).otherwise(F.lit("bad")),
        )
        .when(trimmed.rlike(_NUMBER), F.lit("number"))
        .when(trimmed.rlike(_NOT_FINITE), F.lit("open"))
        .otherwise(F.lit("bad"))
    )
    if when is not None:
        usable = F.when(when, usable)
    df = df.withColumn("_how", usable)
    how = F.col("_how")
    value = (
        F.when(how == "number", F.regexp_replace(trimmed, "_", "").try_cast("double"))
        .when(how == "bool", (text == "true").cast("double"))
        .when(how.isin("zero", "bad"), F.lit(0.0))
    )
    # an exponent too large for a double overflows to infinity
    value = F.when(F.abs(value) < F.lit(float("inf")), value)
    if clamp:
        value = F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
    name = F.coalesce(F.col("_obj.label"), F.lit(""))
    if strict:
        name = F.lower(strip(name))
        label = F.when((how != "bad") & in_domain(name, classes), name)
    else:
        label = F.when(how == "bad", F.lit("")).when(how.isNotNull(), normalize_reply(name))
    read = {"label": label, "confidence": value, "parse_error": how == "bad"}
    return settle(df, read, drop=("_obj", "_how"))


def enum_or_default(c: Column, allowed, default: str) -> Column:
    v = F.lower(strip(c))
    return F.when(v.isin(*allowed), v).otherwise(F.lit(default))


def target_name(c: Column, is_text: Column | None = None) -> Column:
    """NULL for null, empty, ``null``, ``none`` and non-strings; else stripped."""
    keep = c.isNotNull() & (c != "") & ~F.lower(c).isin("null", "none")
    if is_text is not None:
        keep = keep & is_text
    return F.when(keep, strip(c))


def is_text_field(raw: Column, text: Column, name: str) -> Column:
    """False for numbers, booleans, lists and objects under ``name``; of a repeated key
    the last counts. Only values that look like one of those pay for a second parse, which
    asks for the type and takes no quoted value."""
    typed = lambda kind: F.from_json(raw, f"struct<{name}:{kind}>", _STRICT)[name].isNotNull()
    other = (
        F.when(text.rlike(r"^-?\d[\d.eE+-]*$"), typed("double"))
        .when(text.isin("true", "false"), typed("boolean"))
        .when(text.startswith("["), typed("array<string>"))
        .when(text.startswith("{"), typed("map<string,string>"))
    )
    return ~F.coalesce(other, F.lit(False))


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(c) == "true", F.lit(False))


def rich_struct(
    primary: Column, secondary: Column, kind: Column, name: Column, urgency: Column, negation: Column
) -> Column:
    """The six typed fields, each unusable value replaced by its default."""
    return F.struct(
        enum_or_default(primary, INTENTS, RICH_DEFAULTS["primary_intent"]).alias("primary_intent"),
        enum_or_default(secondary, SECONDARY_INTENTS, RICH_DEFAULTS["secondary_intent"]).alias(
            "secondary_intent"
        ),
        enum_or_default(kind, TARGET_TYPES, RICH_DEFAULTS["target_type"]).alias("target_type"),
        name.alias("target_name"),
        enum_or_default(urgency, URGENCIES, RICH_DEFAULTS["urgency"]).alias("urgency"),
        truthy(negation).alias("negation"),
    )
