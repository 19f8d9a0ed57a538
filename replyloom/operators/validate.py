"""Validation of chat training lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import INTENTS, ROLES, USER_LENGTH
from replyloom.functions.replies import is_text_field, with_object
from replyloom.functions.settle import settle
from replyloom.functions.text import JSON_WHITESPACE, fingerprint, in_domain, strip
from replyloom.operators.skew import lookup_counted
from replyloom.session import cut_lineage

_LENIENT_OFF = {"allowSingleQuotes": "false"}


def _error(code: str, detail: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), detail.cast("string").alias("detail"))


def _any_json(raw: Column) -> Column:
    """A single JSON value of any type."""
    body = F.btrim(raw, F.lit(JSON_WHITESPACE))
    items = F.from_json(F.concat(F.lit("["), body, F.lit(',"m"]')), "array<string>", _LENIENT_OFF)
    return F.coalesce((F.size(items) == 2) & (F.get(items, F.lit(1)) == "m"), F.lit(False))


def validate_lines(
    lines: DataFrame,
    raw: str = "raw",
    *,
    classes=INTENTS,
    roles=ROLES,
    bounds: tuple[int, int] = USER_LENGTH,
) -> DataFrame:
    """Add ``user`` and ``errors ARRAY<STRUCT<code, detail>>`` to each non-blank
    line. A pure projection: the order of checks is the order of the CASE arms.
    """
    src = F.col(raw)
    df = lines.filter(F.length(strip(src)) > 0)
    df = with_object(df, raw, "messages:string", "_doc")
    text = F.col("_doc.messages")
    df = df.withColumn(
        "_items",
        F.when(
            text.startswith("[") & is_text_list(src, text),
            F.from_json(text, "array<string>", _LENIENT_OFF),
        ),
    )
    df = df.withColumn(
        "_msgs",
        F.when(
            F.size("_items") == len(roles),
            F.transform(
                "_items",
                lambda e: F.when(
                    e.startswith("{"),
                    F.struct(F.from_json(e, "struct<role:string,content:string>", _LENIENT_OFF).alias("m"), e.alias("src")),
                ),
            ),
        ),
    )
    checks = []
    for i, role in enumerate(roles):
        slot = F.get(F.col("_msgs"), F.lit(i))
        got, content = slot["m"]["role"], slot["m"]["content"]
        is_text = is_text_field(slot["src"], content, "content")
        blank = ~F.coalesce((F.length(strip(content)) > 0) & is_text, F.lit(False))
        checks += [
            F.when(slot.isNull(), _error("not_an_object", F.lit(i))),
            F.when(slot.isNotNull() & ~got.eqNullSafe(F.lit(role)), _error("wrong_role", F.lit(i))),
            F.when(slot.isNotNull() & blank, _error("empty_content", F.lit(i))),
        ]
    shape = (
        F.when(
            F.col("_doc").isNull(),
            F.when(
                ~F.btrim(src, F.lit(JSON_WHITESPACE)).startswith("{") & _any_json(src),
                F.array(_error("line_not_object", F.lit(None))),
            ).otherwise(F.array(_error("invalid_json", F.lit(None)))),
        )
        .when(F.col("_items").isNull(), F.array(_error("no_message_list", F.lit(None))))
        .when(F.size("_items") != len(roles), F.array(_error("message_count", F.size("_items"))))
        .otherwise(F.array_compact(F.array(*checks)))
    )
    df = df.withColumn("_shape", shape)
    user = F.get(F.col("_msgs"), F.lit(1))["m"]["content"]
    label = F.get(F.col("_msgs"), F.lit(2))["m"]["content"]
    low, high = bounds
    content_checks = F.array_compact(
        F.array(
            F.when(~in_domain(label, classes), _error("label_outside", label)),
            F.when(F.length(user) < low, _error("too_short", F.length(user))),
            F.when(F.length(user) > high, _error("too_long", F.length(user))),
        )
    )
    errors = F.when(F.size("_shape") > 0, F.col("_shape")).otherwise(content_checks)
    judged = {"errors": errors, "user": F.when(F.size("_shape") == 0, user)}
    return settle(df, judged, drop=("_doc", "_items", "_msgs", "_shape"))


def is_text_list(raw: Column, text: Column) -> Column:
    """False when ``messages`` is a string that merely looks like a list; of a repeated key the
    last counts."""
    quoted = raw.rlike(r'"messages"\s*:\s*"')
    real = F.from_json(raw, "struct<messages:array<string>>", {"allowSingleQuotes": "false"})["messages"].isNotNull()
    return F.when(quoted, real).otherwise(F.lit(True))


def _judged(validated: DataFrame, file: str, line_no: str) -> DataFrame:
    """Each line's place, errors and, without errors, the fingerprint of its user text, written once:
    grouping lines and looking their groups up then reads slim rows and parses nothing again."""
    mark = F.when(F.size("errors") == 0, fingerprint(F.col("user")))
    return cut_lineage(validated.select(F.col(file).alias("file"), F.col(line_no).alias("line_no"), "errors", mark.alias("_fp")), "validated")


def _clean(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("errors") == 0).select("file", "line_no", "_fp")


def _groups(clean: DataFrame) -> DataFrame:
    return clean.groupBy("file", "_fp").agg(
        F.min("line_no").alias("first_line"), F.count(F.lit(1)).alias("_copies")
    )


def duplicate_users(validated: DataFrame, file: str = "file", line_no: str = "line_no") -> DataFrame:
    """Lines without another error that repeat an earlier user text of their file,
    with the line that had it first."""
    return _duplicates(_clean(_judged(validated, file, line_no)))


def _duplicates(clean: DataFrame) -> DataFrame:
    repeated = _groups(clean).filter(F.col("_copies") > 1)
    return (
        lookup_counted(clean, repeated, ["file", "_fp"], "_copies", F.col("line_no"))
        .filter(F.col("line_no") > F.col("first_line"))
        .select("file", "line_no", "first_line")
    )


def validation_errors(validated: DataFrame, file: str = "file", line_no: str = "line_no") -> DataFrame:
    """Every error as a row: those inside a line, then the duplicates."""
    judged = _judged(validated, file, line_no)
    own = judged.select("file", "line_no", F.inline("errors"))
    dup = _duplicates(_clean(judged)).select(
        "file", "line_no", F.lit("duplicate_user").alias("code"), F.col("first_line").cast("string").alias("detail")
    )
    return own.unionByName(dup)


def validate_summary(
    validated: DataFrame, file: str = "file", line_no: str = "line_no", expected_files: DataFrame | None = None
) -> DataFrame:
    """Verdict per file. Duplicates are counted as copies minus one from the same
    grouping that would find them, so nothing is joined back to the lines.
    ``expected_files(file, found)`` adds files without lines: one that was not
    found is one error, an empty one is fine."""
    judged = _judged(validated, file, line_no)
    own = judged.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.size("errors")).alias("_own")
    )
    dup = _groups(_clean(judged)).groupBy("file").agg(
        F.sum(F.col("_copies") - 1).alias("_dup")
    )
    out = own.join(dup, "file", "left")
    if expected_files is not None:
        out = expected_files.select("file", "found").join(out, "file", "left")
        missing = (~F.col("found")).cast("bigint")
    else:
        missing = F.lit(0)
    errors = F.coalesce("_own", F.lit(0)) + F.coalesce("_dup", F.lit(0)) + missing
    return out.select(
        "file",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        errors.cast("bigint").alias("n_errors"),
        F.when(errors == 0, F.lit("OK")).otherwise(F.lit("FAIL")).alias("verdict"),
    )
