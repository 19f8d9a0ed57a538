"""Queries: six-field extraction, one call against four."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyloom import domain
from replyloom.functions.numeric import half_even
from replyloom.operators import compare, extract as x
from replyloom.plans import derive as d
from replyloom.plans.registry import query, with_ctes
from replyloom.plans.sqltext import COST, WS, share, where

FIELDS = d.RICH


def _items(spark, sf):
    return d.rich_items(d.requests(spark, sf))


def _scored(spark, sf, run):
    items = _items(spark, sf)
    fold = x.extract_mono if run == "mono" else x.extract_multi
    return x.score_extraction(d.rich_expected(items), fold(d.rich_replies(items, run).filter(d.RECORDED)))


def _enum(doc: str, field: str, allowed, default: str) -> str:
    v = f"lower(trim(json_extract_string({doc}, '$.{field}'), {WS}))"
    ok = f"json_type({doc}, '$.{field}') = 'VARCHAR' AND {v} IN (" + ", ".join(f"'{a}'" for a in allowed) + ")"
    return f"CASE WHEN {ok} THEN {v} ELSE '{default}' END AS {field}"


def _six(primary: str, target: str, mood: str) -> str:
    name = f"json_extract_string({target}, '$.target_name')"
    return ", ".join(
        [
            _enum(primary, "primary_intent", domain.INTENTS, "modify"),
            _enum(primary, "secondary_intent", domain.SECONDARY_INTENTS, "none"),
            _enum(target, "target_type", domain.TARGET_TYPES, "other"),
            f"""CASE WHEN json_type({target}, '$.target_name') = 'VARCHAR' AND {name} <> ''
              AND lower({name}) NOT IN ('null', 'none') THEN trim({name}, {WS}) END AS target_name""",
            _enum(mood, "urgency", domain.URGENCIES, "normal"),
            f"coalesce(lower(json_extract_string({mood}, '$.negation')) = 'true', false) AS negation",
        ]
    )


def _match(p: str, e: str) -> str:
    return ", ".join(
        f"{p}.n_calls IS NOT NULL AND lower(coalesce({p}.{f}, '')) = lower(coalesce({e}.{f}, '')) AS m_{f}" if f == "target_name"
        else f"coalesce({p}.{f} = {e}.{f}, false) AS m_{f}"
        for f in FIELDS
    )


_ALL = " AND ".join(f"m_{f}" for f in FIELDS)
X_SQL = {
    "docs": f"""SELECT *, {COST} AS cost, CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END AS doc,
      NOT json_valid(raw) AS broken FROM rich_replies""",
    "mono": f"""SELECT request_id, {_six('doc', 'doc', 'doc')}, broken::int AS parse_errors, 1::bigint AS n_calls,
      cost AS total_cost, latency_ms AS total_latency_ms, latency_ms AS wall_latency_ms FROM docs WHERE run_id = 'mono'""",
    "multi": f"""SELECT n.request_id, {_six('c.doc', 't.doc', 's.doc')},
      n.broken::int + c.broken::int + t.broken::int + s.broken::int AS parse_errors, 4::bigint AS n_calls,
      n.cost + c.cost + t.cost + s.cost AS total_cost,
      n.latency_ms + c.latency_ms + t.latency_ms + s.latency_ms AS total_latency_ms,
      n.latency_ms + greatest(c.latency_ms, t.latency_ms, s.latency_ms) AS wall_latency_ms
      FROM (SELECT * FROM docs WHERE stage = 'normalize') n JOIN (SELECT * FROM docs WHERE stage = 'classify') c USING (request_id)
      JOIN (SELECT * FROM docs WHERE stage = 'target') t USING (request_id)
      JOIN (SELECT * FROM docs WHERE stage = 'sentiment') s USING (request_id)""",
    **{
        f"{run}_scored": f"""SELECT *, {_ALL} AS correct FROM (SELECT g.request_id, g."user", {_match('p', 'g')},
        p AS p, g.target_name AS gold_name FROM rich g LEFT JOIN (SELECT * FROM (SELECT *, '{run}' AS run_id FROM {run}) WHERE {d.RECORDED}) p USING (request_id))"""
        for run in ("mono", "multi")
    },
}


def _check(body, extra=None):
    return with_ctes(["rich_replies"], body, {**X_SQL, **(extra or {})})


def _flat(df):
    return df.select(
        "request_id",
        *[F.col(f"predicted.{f}").alias(f) for f in FIELDS],
        "parse_errors",
        "n_calls",
        half_even(F.col("total_cost"), 9).alias("total_cost"),
        half_even(F.col("total_latency_ms"), 6).alias("total_latency_ms"),
        half_even(F.col("wall_latency_ms"), 6).alias("wall_latency_ms"),
    )


_FLAT = f"""request_id, {', '.join(FIELDS)}, parse_errors, n_calls, round_even(total_cost, 9) AS total_cost,
    round_even(total_latency_ms, 6) AS total_latency_ms, round_even(wall_latency_ms, 6) AS wall_latency_ms"""


@query("extract_mono", _check(f"SELECT {_FLAT} FROM mono"))
def extract_mono(spark, sf):
    return _flat(x.extract_mono(d.rich_replies(_items(spark, sf), "mono")))


@query("extract_multi", _check(f"SELECT {_FLAT} FROM multi"))
def extract_multi(spark, sf):
    return _flat(x.extract_multi(d.rich_replies(_items(spark, sf), "multi")))


@query(
    "stage_inputs",
    _check(
        """SELECT request_id, 'REQUEST: ' || "user" || chr(10) || 'FEATURES: ' || doc AS stage_input
        FROM rich JOIN docs USING (request_id) WHERE stage = 'normalize'"""
    ),
)
def stage_inputs(spark, sf):
    items = _items(spark, sf)
    return x.stage_inputs(items, d.rich_replies(items, "multi"))


def _accuracy_sql(run: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{run}' AS run_id, '{f}' AS field, {where(c)} AS n_correct, count(*) AS total,
        {share(where(c), digits=4)} AS rate FROM {run}_scored"""
        for f, c in [(f, f"m_{f}") for f in FIELDS] + [("composite", "correct")]
    )


_ACC = {"acc": _accuracy_sql("mono") + " UNION ALL " + _accuracy_sql("multi")}


def _accuracy(spark, sf):
    both = None
    for run in ("mono", "multi"):
        one = x.field_accuracy(_scored(spark, sf, run)).withColumn("run_id", F.lit(run))
        both = one if both is None else both.unionByName(one)
    return both


@query("field_accuracy", _check("SELECT * FROM acc", _ACC))
def field_accuracy(spark, sf):
    return _accuracy(spark, sf)


@query(
    "field_delta",
    _check(
        """SELECT field, a.rate AS first_rate, b.rate AS second_rate, round_even((b.rate - a.rate) * 100, 4) AS delta_pp
        FROM acc a JOIN acc b USING (field) WHERE a.run_id = 'mono' AND b.run_id = 'multi'""",
        _ACC,
    ),
)
def field_delta(spark, sf):
    return x.field_delta(_accuracy(spark, sf), "mono", "multi")


@query(
    "field_errors",
    _check(
        " UNION ALL ".join(
            f"SELECT '{f}' AS field, count(*) AS total, {where(f'NOT m_{f}')} AS n_errors FROM multi_scored" for f in FIELDS
        )
    ),
)
def field_errors(spark, sf):
    return x.field_errors(_scored(spark, sf, "multi"))


@query(
    "token_usage",
    _check(
        """SELECT run_id, tokens_in, tokens_out, tokens_in + tokens_out AS tokens_total,
        round_even(tokens_in::double / (SELECT tokens_in FROM per WHERE run_id = 'mono'), 6) AS in_ratio,
        round_even(tokens_out::double / (SELECT tokens_out FROM per WHERE run_id = 'mono'), 6) AS out_ratio FROM per""",
        {
            "per": """SELECT run_id, cast(sum(input_tokens) AS bigint) AS tokens_in, cast(sum(output_tokens) AS bigint) AS tokens_out
            FROM rich_replies GROUP BY 1"""
        },
    ),
)
def token_usage(spark, sf):
    items = _items(spark, sf)
    rep = d.rich_replies(items, "mono").unionByName(d.rich_replies(items, "multi"))
    return x.token_usage(rep, "mono")


_MISSED = lambda s: "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN NOT {s}.m_{f} THEN '{f}' END" for f in FIELDS
) + "], lambda v: v IS NOT NULL), ',')"


@query(
    "mode_disagreement",
    _check(
        f"""SELECT request_id, CASE WHEN a.correct THEN 'first_only' ELSE 'second_only' END AS outcome,
        CASE WHEN a.correct THEN {_MISSED('b')} ELSE {_MISSED('a')} END AS missed, a."user"[:60] AS preview
        FROM mono_scored a JOIN multi_scored b USING (request_id) WHERE a.correct <> b.correct"""
    ),
)
def mode_disagreement(spark, sf):
    return x.mode_disagreement(_scored(spark, sf, "mono"), _scored(spark, sf, "multi"))


@query(
    "mode_matrix",
    _check(
        """SELECT o.outcome, count(x.request_id) AS n
        FROM (VALUES ('both'), ('first_only'), ('second_only'), ('neither'), ('unmatched')) AS o(outcome)
        LEFT JOIN (SELECT request_id, CASE WHEN a.correct AND b.correct THEN 'both' WHEN a.correct THEN 'first_only'
          WHEN b.correct THEN 'second_only' ELSE 'neither' END AS outcome
          FROM mono_scored a JOIN multi_scored b USING (request_id)) x USING (outcome) GROUP BY 1"""
    ),
)
def mode_matrix(spark, sf):
    return compare.outcome_matrix(_scored(spark, sf, "mono"), _scored(spark, sf, "multi"))


_SAME = " AND ".join(f"a.p.{f} IS NOT DISTINCT FROM b.p.{f}" for f in FIELDS)


@query(
    "mode_vote",
    _check(
        f"""SELECT CASE WHEN {_SAME} THEN 'accept' ELSE 'review' END AS verdict, count(*) AS n,
        {where('a.correct')} AS first_right, {share(where('a.correct'))} AS first_accuracy
        FROM mono_scored a JOIN multi_scored b USING (request_id) GROUP BY 1"""
    ),
)
def mode_vote(spark, sf):
    return x.mode_vote(_scored(spark, sf, "mono"), _scored(spark, sf, "multi"))


_HYBRID = {f: ("b" if f in ("target_type", "target_name") else "a") for f in FIELDS}


@query(
    "hybrid_fields",
    _check(
        f"""SELECT request_id, {', '.join(f'{s}.p.{f} AS {f}' for f, s in _HYBRID.items())},
        {' AND '.join(f'{s}.m_{f}' for f, s in _HYBRID.items())} AS correct
        FROM mono_scored a JOIN multi_scored b USING (request_id)"""
    ),
)
def hybrid_fields(spark, sf):
    out = x.hybrid_fields(_scored(spark, sf, "mono"), _scored(spark, sf, "multi"))
    return out.select("request_id", *[F.col(f"predicted.{f}").alias(f) for f in FIELDS], "correct")


@query(
    "target_hallucination",
    _check(
        f"""SELECT {where('p.target_name IS NOT NULL')} AS named,
        {where('NOT contains(lower("user"), lower(p.target_name))')} AS invented,
        {where('gold_name IS NOT NULL')} AS gold_named,
        {where('NOT contains(lower("user"), lower(gold_name))')} AS gold_absent FROM mono_scored"""
    ),
)
def target_hallucination(spark, sf):
    return x.target_hallucination(_scored(spark, sf, "mono"))
