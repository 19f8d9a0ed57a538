"""Queries: reading replies, pricing them, scoring one run."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyloom.domain import EMBED_MODEL, PRICES
from replyloom.functions.numeric import embed_cost, nanos, usd_from_nanos
from replyloom.functions.replies import with_reply
from replyloom.functions.text import normalize_reply, strict_format
from replyloom.operators import compare, metrics, route, score
from replyloom.plans import derive as d
from replyloom.plans.registry import query, with_ctes
from replyloom.plans.sqltext import (
    CLASS_ROWS, CLASSES, COST, normal, parsed, parsed_strict, ratio_or_null, share, strict, usd, where,
)


@query(
    "reply_normalize",
    with_ctes(
        ["replies"],
        f"""SELECT request_id, call_no, {normal('raw')} AS label, {strict('raw')} AS strict_ok
        FROM replies WHERE run_id IN ('baseline', 'gate') AND stage = 'plain'""",
    ),
)
def reply_normalize(spark, sf):
    rep = d.replies(d.requests(spark, sf), "baseline", "gate").filter(F.col("stage") == "plain")
    return rep.select(
        "request_id", "call_no", normalize_reply(F.col("raw")).alias("label"), strict_format(F.col("raw")).alias("strict_ok")
    )


_JSON_RUN = "(SELECT * FROM replies WHERE run_id = 'cheap')"


@query(
    "parse_reply",
    with_ctes(["replies"], f"SELECT request_id, label, confidence, parse_error FROM ({parsed(_JSON_RUN)})"),
)
def parse_reply(spark, sf):
    rep = d.replies(d.requests(spark, sf), "cheap")
    return with_reply(rep).select("request_id", "label", "confidence", "parse_error")


@query(
    "parse_reply_strict",
    with_ctes(["replies"], f"SELECT request_id, label, confidence, parse_error FROM ({parsed_strict(_JSON_RUN)})"),
)
def parse_reply_strict(spark, sf):
    rep = d.replies(d.requests(spark, sf), "cheap")
    return with_reply(rep, strict=True).select("request_id", "label", "confidence", "parse_error")


@query(
    "call_cost",
    with_ctes(
        ["replies", "micro"],
        f"""SELECT run_id, model, unknown_model, count(*) AS n_calls, {usd('cost')} AS cost FROM (
          SELECT run_id, model, false AS unknown_model, {COST} AS cost FROM replies WHERE run_id IN ('cheap', 'strong')
          UNION ALL SELECT run_id, 'unpriced', true, NULL FROM replies WHERE run_id = 'cheap2'
          UNION ALL SELECT 'embed', '{EMBED_MODEL}', false, embed_tokens * ({PRICES[EMBED_MODEL][0]}::double / 1000000) FROM micro)
        GROUP BY ALL""",
    ),
)
def call_cost(spark, sf):
    """Cost per run and model, the unknown model reported rather than failing."""
    reqs = d.requests(spark, sf)
    rep = d.replies(reqs, "cheap", "strong", "cheap2").withColumn(
        "model", F.when(F.col("run_id") == "cheap2", F.lit("unpriced")).otherwise(F.col("model"))
    )
    calls = route.with_cost(rep).select("run_id", "model", "unknown_model", "cost")
    embeds = d.micro(reqs).select(
        F.lit("embed").alias("run_id"), F.lit(EMBED_MODEL).alias("model"), F.lit(False).alias("unknown_model"),
        embed_cost(F.col("embed_tokens")).alias("cost"),
    )
    return calls.unionByName(embeds).groupBy("run_id", "model", "unknown_model").agg(
        F.count(F.lit(1)).alias("n_calls"), usd_from_nanos(F.sum(nanos(F.col("cost")))).alias("cost")
    )


BASE_SQL = {
    "scored": f"""SELECT q.request_id, q."user", q.expected, q.kind, q.lang, v.run AS run_id, {normal('raw')} AS final_label,
      coalesce({strict('raw')}, false) AS format_ok, coalesce({normal('raw')} = expected, false) AS correct
      FROM requests q CROSS JOIN (VALUES ('baseline'), ('tuned'), ('tuned_again')) AS v(run)
      LEFT JOIN (SELECT * FROM replies WHERE {d.RECORDED}) r ON r.request_id = q.request_id AND r.run_id = v.run""",
    "base": "SELECT * EXCLUDE (run_id) FROM scored WHERE run_id = 'baseline'",
}


def _scored(spark, sf, run="baseline"):
    reqs = d.requests(spark, sf)
    return metrics.score_plain(d.slim(reqs), d.replies(reqs, run).filter(d.RECORDED))


def _check(body, *more):
    return with_ctes(["replies", *more], body, BASE_SQL)


@query(
    "baseline_eval",
    _check("SELECT request_id, expected, kind, final_label, format_ok, correct FROM base"),
)
def baseline_eval(spark, sf):
    return _scored(spark, sf).select("request_id", "expected", "kind", "final_label", "format_ok", "correct")


@query(
    "constant_baseline",
    with_ctes(
        ["requests"],
        f"""SELECT 'search' AS label, count(*) AS total, {where("expected = 'search'")} AS n_correct,
        {share(where("expected = 'search'"))} AS accuracy FROM requests
        UNION ALL SELECT (SELECT label FROM top), count(*), (SELECT n FROM top), {share("(SELECT n FROM top)")} FROM requests""",
        {
            "top": f"""SELECT expected AS label, count(*) AS n FROM requests WHERE expected IN {CLASSES} GROUP BY 1
            ORDER BY 2 DESC, CASE expected WHEN 'search' THEN 0 WHEN 'understand' THEN 1 WHEN 'describe' THEN 2 ELSE 3 END LIMIT 1"""
        },
    ),
)
def constant_baseline(spark, sf):
    """Always the first class, and always the majority class."""
    reqs = d.slim(d.requests(spark, sf))
    fixed = metrics.score_plain(reqs, metrics.constant_reply(reqs, "search"))
    first = metrics.accuracy(fixed).withColumn("label", F.lit("search"))
    top = metrics.majority_class(reqs, "expected")
    best = top.select("label").scalar()
    guess = reqs.withColumn("correct", F.col("expected") == best)
    return first.unionByName(metrics.accuracy(guess).withColumn("label", best))


@query(
    "accuracy",
    _check(
        f"""SELECT run_id, count(*) AS total, {where('correct')} AS n_correct, {share(where('correct'))} AS accuracy,
        {where('format_ok')} AS n_strict, {share(where('format_ok'))} AS strict_ratio
        FROM scored WHERE run_id IN ('baseline', 'tuned') GROUP BY 1""",
    ),
)
def accuracy(spark, sf):
    reqs = d.requests(spark, sf)
    names = ("baseline", "tuned")
    rep = d.replies(reqs, *names).filter(d.RECORDED)
    asked = d.slim(reqs).withColumn("run_id", F.explode(F.array(*[F.lit(n) for n in names])))
    rows = asked.join(rep.select("request_id", "run_id", "raw"), ["request_id", "run_id"], "left")
    rows = rows.select(
        "run_id",
        F.coalesce(normalize_reply(F.col("raw")) == F.col("expected"), F.lit(False)).alias("correct"),
        strict_format(F.col("raw")).alias("format_ok"),
    )
    return metrics.accuracy_and_format(rows, ["run_id"])


@query(
    "per_class_accuracy",
    _check(
        f"""SELECT c.label, count(*) FILTER (correct) AS n_correct, count(b.request_id) AS total,
        {ratio_or_null('count(*) FILTER (correct)', 'count(b.request_id)')} AS accuracy
        FROM {CLASS_ROWS} LEFT JOIN base b ON b.expected = c.label GROUP BY 1""",
    ),
)
def per_class_accuracy(spark, sf):
    return metrics.per_class_accuracy(_scored(spark, sf))


@query(
    "class_coverage",
    _check(
        f"""SELECT array_to_string(list_sort(list(DISTINCT final_label) FILTER (final_label IN {CLASSES})), ',') AS classes_present,
        cast(count(DISTINCT final_label) FILTER (final_label IN {CLASSES}) AS int) AS n_present FROM base""",
    ),
)
def class_coverage(spark, sf):
    return metrics.class_coverage(_scored(spark, sf))


@query(
    "confusion_matrix",
    _check("SELECT expected, final_label AS predicted, count(*) AS n FROM base GROUP BY 1, 2"),
)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_scored(spark, sf))


@query(
    "confused_pairs",
    _check("SELECT expected, final_label AS predicted, count(*) AS n FROM base WHERE expected IS DISTINCT FROM final_label GROUP BY 1, 2"),
)
def confused_pairs(spark, sf):
    return metrics.confused_pairs(_scored(spark, sf))


@query(
    "filtered_accuracy",
    _check(f"""SELECT {where("correct AND kind <> 'holdout'")} AS n_correct, {where("kind <> 'holdout'")} AS total FROM base"""),
)
def filtered_accuracy(spark, sf):
    return metrics.filtered_accuracy(_scored(spark, sf), F.col("kind") != "holdout")


@query(
    "accuracy_by_lang",
    _check(
        f"SELECT lang, count(*) AS total, {where('correct')} AS n_correct, {share(where('correct'))} AS accuracy FROM base GROUP BY 1"
    ),
)
def accuracy_by_lang(spark, sf):
    return metrics.accuracy(_scored(spark, sf), ["lang"])


_SLICES = {
    "all": "true",
    "short": 'length("user") < 30',
    "code": f"""regexp_matches("user", '{metrics.CODE_PATTERN}')""",
    "rude": f"""regexp_matches("user", '{metrics.RUDE_PATTERN}')""",
}


@query(
    "style_slices",
    _check(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS slice, count(*) AS total, {where('correct')} AS n_correct,
            {ratio_or_null(where('correct'), 'count(*)')} AS accuracy FROM base WHERE {c}"""
            for n, c in _SLICES.items()
        )
    ),
)
def style_slices(spark, sf):
    return metrics.style_slices(_scored(spark, sf))


@query(
    "run_stability",
    _check(
        """SELECT count(*) AS total, count(*) FILTER (a.final_label = b.final_label) AS same,
        count(*) = count(*) FILTER (a.final_label = b.final_label) AS stable
        FROM (SELECT * FROM scored WHERE run_id = 'tuned') a JOIN (SELECT * FROM scored WHERE run_id = 'tuned_again') b USING (request_id)"""
    ),
)
def run_stability(spark, sf):
    return compare.run_stability(_scored(spark, sf, "tuned"), _scored(spark, sf, "tuned_again"))


_WORST = "least(" + ", ".join(
    f"count(*) FILTER (correct AND expected = '{c}')::double / nullif({where(f'''expected = '{c}' ''')}, 0)"
    for c in ("search", "understand", "describe", "modify")
) + ")"


@query(
    "release_gate",
    _check(
        f"""SELECT round_even(accuracy, 6) AS accuracy, round_even(base_accuracy, 6) AS base_accuracy,
          round_even(worst, 6) AS worst_class, round_even(strict_ratio, 6) AS strict_ratio, n_present,
          round_even(accuracy - base_accuracy, 9) >= 0.1::double AS accuracy_ok, worst >= 0.5 AS classes_ok,
          strict_ratio >= 1 AS format_ok, stable AS stable_ok, n_present >= 3 AS coverage_ok,
          round_even(accuracy - base_accuracy, 9) >= 0.1::double AND worst >= 0.5 AND strict_ratio >= 1 AND stable AND n_present >= 3 AS released
        FROM (SELECT {where('correct')}::double / count(*) AS accuracy, {_WORST} AS worst,
            {where('format_ok')}::double / count(*) AS strict_ratio,
            cast(count(DISTINCT final_label) FILTER (final_label IN {CLASSES}) AS int) AS n_present,
            (SELECT {where('correct')}::double / count(*) FROM base) AS base_accuracy,
            (SELECT count(*) = count(*) FILTER (a.final_label = b.final_label)
              FROM (SELECT * FROM scored WHERE run_id = 'tuned') a
              JOIN (SELECT * FROM scored WHERE run_id = 'tuned_again') b USING (request_id)) AS stable
          FROM scored WHERE run_id = 'tuned')"""
    ),
)
def release_gate(spark, sf):
    tuned = _scored(spark, sf, "tuned")
    stability = compare.run_stability(tuned, _scored(spark, sf, "tuned_again"))
    return metrics.release_gate(tuned, _scored(spark, sf), stability)


_RULES = {"search": r"\bfind\b", "understand": r"\b(?:explain|why)\b", "describe": r"\bdescribe\b"}


@query(
    "score_requests",
    with_ctes(
        ["requests"],
        "SELECT request_id, 'rules' AS run_id, 1 AS call_no, CASE "
        + " ".join(f"""WHEN regexp_matches("user", '(?i){p}') THEN '{c}'""" for c, p in _RULES.items())
        + " ELSE 'modify' END AS raw FROM requests",
    ),
)
def score_requests(spark, sf):
    """The extension point with keyword rules as the scorer."""
    reqs = d.slim(d.requests(spark, sf))
    rep = score.score_requests(reqs, score.keyword_scorer(_RULES, "modify"), run_id="rules", model="rules")
    return rep.select("request_id", "run_id", "call_no", "raw")
