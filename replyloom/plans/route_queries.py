"""Queries: routing replays, their summaries, and run comparisons."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F, types as T

from replyloom.domain import ROUTED_ROW
from replyloom.functions.numeric import half_even
from replyloom.operators import compare, route as t
from replyloom.operators.quantiles import index_percentiles
from replyloom.plans import derive as d
from replyloom.plans.registry import query, with_ctes
from replyloom.plans.reply_queries import BASE_SQL, _scored as baseline_rows
from replyloom.plans.sqltext import CLASSES, COST, parsed, parsed_strict, share, usd, where
from replyloom.session import shared_folder
from replyloom.sources import runs


_RECORDED = d.RECORDED
# nor are some embeddings
_EMBEDDED = "request_id % 43 <> 5"


def _inputs(spark, sf, *names):
    reqs = d.requests(spark, sf)
    return d.slim(reqs), d.replies(reqs, *names).filter(_RECORDED)


def _router(spark, sf, **kw):
    return t.route_replay(*_inputs(spark, sf, "cheap", "strong"), **kw)


def _modes(spark, sf):
    return t.replay_modes(*_inputs(spark, sf, "cheap", "strong"))


def _whole_micro(spark, sf):
    """Small-model routing where every request has its embedding and its reply."""
    reqs = d.requests(spark, sf)
    return t.micro_route(d.slim(reqs), d.micro(reqs), d.replies(reqs, "cheap"))


def _micro(spark, sf, **kw):
    reqs, replies = _inputs(spark, sf, "cheap")
    return t.micro_route(reqs, d.micro(d.requests(spark, sf)).filter(_EMBEDDED), replies, **kw)


def _unsure(p: str, below: str = "0.85") -> str:
    return f"coalesce({p}.confidence < {below} OR {p}.label NOT IN {CLASSES}, true)"


def _json_run(run: str) -> str:
    return f"SELECT *, {COST} AS cost FROM (" + parsed(f"(SELECT * FROM replies WHERE run_id = '{run}' AND {_RECORDED})") + ")"


def _made(*calls: tuple[str, str]) -> str:
    """Recorded calls among (call, condition under which it is asked for)."""
    return " + ".join(f"(({c}) AND {p}.model IS NOT NULL)::int" for p, c in calls)


def _added(field: str, *calls: tuple[str, str]) -> str:
    terms = " + ".join(f"CASE WHEN ({c}) AND {p}.model IS NOT NULL THEN {p}.{field} ELSE 0 END" for p, c in calls)
    return f"CASE WHEN {_made(*calls)} > 0 THEN {terms} END"


_ROUTED = (("c", "true"), ("s", "esc"))


RUNS_SQL = {
    **{run: _json_run(run) for run in ("cheap", "cheap2", "mid", "strong")},
    "joined": f"""SELECT q.request_id, q."user", q.expected, q.kind, c AS c, s AS s, {_unsure('c')} AS esc
      FROM requests q LEFT JOIN cheap c USING (request_id) LEFT JOIN strong s USING (request_id)""",
    "router": f"""SELECT request_id, "user", expected, kind, 'router' AS run_id,
      CASE WHEN esc THEN 'escalated' ELSE 'cheap' END AS route,
      CASE WHEN esc THEN s.label ELSE c.label END AS final_label,
      CASE WHEN esc THEN s.confidence ELSE c.confidence END AS final_confidence,
      {_made(*_ROUTED)} AS n_calls, 1 + esc::int - ({_made(*_ROUTED)}) AS n_missing,
      {_added('cost', *_ROUTED)} AS total_cost, {_added('latency_ms', *_ROUTED)} AS total_latency_ms, c.label AS cheap_label,
      coalesce(CASE WHEN esc THEN s.label = expected ELSE c.label = expected END, false) AS correct FROM joined""",
    "singles": " UNION ALL ".join(
        f"""SELECT request_id, "user", expected, kind, '{run}' AS run_id, {v}.model AS route, {v}.label AS final_label,
        {v}.confidence AS final_confidence, ({v}.model IS NOT NULL)::int AS n_calls, ({v}.model IS NULL)::int AS n_missing,
        {v}.cost AS total_cost, {v}.latency_ms AS total_latency_ms,
        NULL AS cheap_label, coalesce({v}.label = expected, false) AS correct FROM joined"""
        for run, v in (("cheap", "c"), ("strong", "s"))
    ),
    "every": "SELECT * FROM router UNION ALL SELECT * FROM singles",
    "fallback": f"SELECT *, {COST} AS cost FROM (" + parsed_strict(f"(SELECT * FROM replies WHERE run_id = 'cheap' AND {_RECORDED})") + ")",
    "microed": f"""SELECT request_id, "user", expected, kind, 'micro' AS run_id, m.micro_label AS micro_label, m.max_proba AS max_proba,
      CASE WHEN up THEN 'escalated' ELSE 'stayed' END AS route,
      CASE WHEN up THEN f.label ELSE m.micro_label END AS final_label,
      CASE WHEN up THEN f.label END AS fallback_label,
      CASE WHEN up THEN f.confidence ELSE m.max_proba END AS final_confidence,
      up AND f.model IS NOT NULL AS fallback_called, (up AND f.model IS NOT NULL)::int AS n_calls, (up AND f.model IS NULL)::int AS n_missing,
      coalesce(m.embed_tokens * (0.02::double / 1000000), 0) AS embed_cost, CASE WHEN up AND f.model IS NOT NULL THEN f.cost ELSE 0 END AS llm_cost,
      coalesce(m.embed_tokens * (0.02::double / 1000000), 0) + CASE WHEN up AND f.model IS NOT NULL THEN f.cost ELSE 0 END AS total_cost,
      CASE WHEN m.micro_label IS NOT NULL OR (up AND f.model IS NOT NULL)
        THEN coalesce(m.embed_latency_ms, 0) + CASE WHEN up AND f.model IS NOT NULL THEN f.latency_ms ELSE 0 END END AS total_latency_ms,
      coalesce(CASE WHEN up THEN f.label ELSE m.micro_label END = expected, false) AS correct
      FROM (SELECT q.*, m AS m, f AS f, NOT coalesce(m.max_proba >= 0.6, false) AS up
        FROM requests q LEFT JOIN (SELECT * FROM micro WHERE {_EMBEDDED}) m USING (request_id) LEFT JOIN fallback f USING (request_id))""",
}


def _check(body, extra=None):
    return with_ctes(["replies", "micro"], body, {**RUNS_SQL, **(extra or {})})


_OUT = (
    "request_id", "route", "final_label", "final_confidence", "n_calls", "total_cost", "total_latency_ms", "correct",
)


def _shown(df, *more):
    return df.select(*[half_even(F.col(c), 9).alias(c) if c == "total_cost" else F.col(c) for c in _OUT + more])


_SHOWN = ", ".join("round_even(total_cost, 9) AS total_cost" if c == "total_cost" else c for c in _OUT)


@query("route_replay", _check(f"SELECT {_SHOWN}, cheap_label FROM router"))
def route_replay(spark, sf):
    return _shown(_router(spark, sf), "cheap_label")


@query("single_model", _check(f"SELECT {_SHOWN} FROM singles WHERE run_id = 'strong'"))
def single_model(spark, sf):
    return _shown(t.single_model(*_inputs(spark, sf, "strong"), "strong"))


def _summary_sql(source: str, by: str = "run_id", more: str = "") -> str:
    lat = "list_sort(list(cast(round_even(total_latency_ms, 0) AS bigint)) FILTER (WHERE total_latency_ms IS NOT NULL))"
    return f"""SELECT {by}, count(*) AS total, {where("kind = 'holdout'")} AS holdout_total,
      {where("kind LIKE 'adv-%'")} AS adv_total, {where('correct')} AS correct_total,
      {where("correct AND kind = 'holdout'")} AS holdout_correct, {where("route = 'escalated'")} AS escalated,
      cast(sum(n_calls) AS bigint) AS api_calls, {usd('total_cost')} AS total_cost_usd, {where('n_calls > 0 AND total_cost IS NULL')} AS n_unpriced, cast(sum(n_missing) AS bigint) AS n_missing,
      {where("route = 'cheap'")} AS route_cheap, {where("route = 'stayed'")} AS route_stayed, {where("route = 'escalated'")} AS route_escalated,{more}
      {lat}[cast(floor(count(total_latency_ms) * 0.5::double) AS bigint) + 1] AS latency_p50_ms,
      {lat}[cast(floor(count(total_latency_ms) * 0.95::double) AS bigint) + 1] AS latency_p95_ms FROM {source} GROUP BY {by}"""


_SUMMARY = {"summary": _summary_sql("every")}


@query("run_summary", _check("SELECT * FROM summary", _SUMMARY))
def run_summary(spark, sf):
    return t.run_summary(_modes(spark, sf))


@query("stored_summary", _check("SELECT *, 0.85::double AS config_threshold FROM summary", _SUMMARY))
def stored_summary(spark, sf):
    """Results stored by run and read again, and their summary stored with its configuration."""
    folder = shared_folder(spark, "runs")
    runs.write_run(_modes(spark, sf), f"{folder}/results")
    runs.write_summary(t.run_summary(runs.read_runs(spark, f"{folder}/results", "cheap", "strong", "router")), {"threshold": 0.85}, f"{folder}/summary")
    return spark.read.parquet(f"{folder}/summary")


_MICRO_MORE = f"""
      {where("correct AND route = 'stayed'")} AS stayed_correct, {where("correct AND route = 'escalated'")} AS escalated_correct,
      {where("correct AND kind LIKE 'adv-%'")} AS adv_correct, cast(sum(n_calls) AS bigint) AS n_llm_calls,
      {usd('embed_cost')} AS embed_cost_usd, {usd('llm_cost')} AS llm_cost_usd,"""


@query("micro_summary", _check(_summary_sql("microed", more=_MICRO_MORE)))
def micro_summary(spark, sf):
    return t.micro_summary(_micro(spark, sf))


@query(
    "headline",
    _check(
        """SELECT run_id, holdout_correct, holdout_total, round_even(holdout_correct::double / holdout_total, 6) AS holdout_accuracy,
        correct_total - holdout_correct AS adv_correct, total - holdout_total AS adv_total,
        round_even(correct_total::double / total, 6) AS total_accuracy, api_calls, total_cost_usd,
        latency_p50_ms, latency_p95_ms FROM summary UNION ALL BY NAME
        SELECT run_id, holdout_correct, holdout_total, round_even(holdout_correct::double / holdout_total, 6) AS holdout_accuracy,
        correct_total - holdout_correct AS adv_correct, total - holdout_total AS adv_total,
        round_even(correct_total::double / total, 6) AS total_accuracy, api_calls, total_cost_usd,
        latency_p50_ms, latency_p95_ms FROM msummary""",
        {**_SUMMARY, "msummary": _summary_sql("microed")},
    ),
)
def headline(spark, sf):
    """Cheap-only, strong-only, routed and small-model-first runs side by side."""
    keep = ("run_id", "kind", "route", "n_calls", "n_missing", "n_unpriced", "total_cost", "total_latency_ms", "correct")
    everything = _modes(spark, sf).select(*keep).unionByName(_micro(spark, sf).select(*keep))
    return t.headline(t.run_summary(everything))


@query(
    "route_distribution",
    _check(
        f"""SELECT r.route, (SELECT count(*) FROM router) AS total, count(x.route) AS n,
        round_even(count(x.route)::double / (SELECT count(*) FROM router), 6) AS share
        FROM (VALUES ('cheap'), ('escalated')) AS r(route) LEFT JOIN router x USING (route) GROUP BY 1"""
    ),
)
def route_distribution(spark, sf):
    return t.route_distribution(_router(spark, sf))


@query(
    "route_accuracy",
    _check(
        f"""SELECT run_id, route, count(*) AS total, {where('correct')} AS n_correct, {share(where('correct'))} AS accuracy
        FROM (SELECT run_id, route, correct FROM router UNION ALL SELECT run_id, route, correct FROM microed) GROUP BY 1, 2"""
    ),
)
def route_accuracy(spark, sf):
    keep = ("run_id", "route", "correct")
    return t.route_accuracy(_router(spark, sf).select(*keep).unionByName(_micro(spark, sf).select(*keep)))


@query(
    "escalation_by_class",
    _check(
        """SELECT "by", value, count(*) FILTER (route <> 'escalated') AS kept, count(*) FILTER (route = 'escalated') AS escalated,
        round_even(count(*) FILTER (route = 'escalated')::double / count(*), 6) AS escalated_share FROM (
          SELECT CASE WHEN kind = 'holdout' THEN 'class' ELSE 'kind' END AS "by",
            CASE WHEN kind = 'holdout' THEN expected ELSE kind END AS value, route FROM router) GROUP BY 1, 2"""
    ),
)
def escalation_by_class(spark, sf):
    return t.escalation_by_class(_router(spark, sf))


@query(
    "cost_saving",
    _check(
        """SELECT b.run_id AS base_run, b.total_cost_usd AS base_cost, r.total_cost_usd AS run_cost,
        round_even((b.total_cost_usd - r.total_cost_usd) / b.total_cost_usd, 6) AS saving,
        round_even(r.total_cost_usd / b.total_cost_usd, 6) AS cost_ratio
        FROM summary b JOIN summary r ON r.run_id = 'router' WHERE b.run_id IN ('cheap', 'strong')""",
        _SUMMARY,
    ),
)
def cost_saving(spark, sf):
    return t.cost_saving(t.run_summary(_modes(spark, sf)), "router", ("cheap", "strong"))


@query(
    "latency_percentiles",
    _check(
        """SELECT run_id, route, count(*) AS n,
        list_sort(list(cast(round_even(total_latency_ms, 0) AS bigint)) FILTER (WHERE total_latency_ms IS NOT NULL))[cast(floor(count(total_latency_ms) * 0.5::double) AS bigint) + 1] AS latency_p50_ms,
        list_sort(list(cast(round_even(total_latency_ms, 0) AS bigint)) FILTER (WHERE total_latency_ms IS NOT NULL))[cast(floor(count(total_latency_ms) * 0.95::double) AS bigint) + 1] AS latency_p95_ms
        FROM every GROUP BY 1, 2"""
    ),
)
def latency_percentiles(spark, sf):
    return index_percentiles(_modes(spark, sf), ["run_id", "route"], F.col("total_latency_ms"))


@query(
    "latency_combine",
    _check(
        """SELECT g.request_id, slowest, together, m.total_latency_ms AS routed FROM (
          SELECT request_id, max(latency_ms) AS slowest, round_even(sum(latency_ms), 6) AS together
          FROM replies WHERE run_id = 'gate' GROUP BY 1) g JOIN router m USING (request_id)"""
    ),
)
def latency_combine(spark, sf):
    """Parallel calls cost the slowest, sequential ones their sum."""
    rep = d.replies(d.requests(spark, sf), "gate")
    per = rep.groupBy("request_id").agg(
        F.max("latency_ms").alias("slowest"), half_even(F.sum("latency_ms")).alias("together")
    )
    routed = _router(spark, sf).select("request_id", F.col("total_latency_ms").alias("routed"))
    return per.join(routed, "request_id")


@query(
    "run_explode",
    _check(
        """SELECT request_id, route, 1 AS call_no, c.model AS model, c.label AS label, c.confidence AS confidence,
          c.input_tokens AS input_tokens, c.output_tokens AS output_tokens, c.latency_ms AS latency_ms FROM router JOIN joined USING (request_id) WHERE c.model IS NOT NULL
        UNION ALL SELECT request_id, route, 1 + (c.model IS NOT NULL)::int, s.model, s.label, s.confidence, s.input_tokens, s.output_tokens, s.latency_ms
        FROM router JOIN joined USING (request_id) WHERE route = 'escalated' AND s.model IS NOT NULL"""
    ),
)
def run_explode(spark, sf):
    """The routed run stored as documents of some thousand requests, read back and its calls laid out."""
    row = T.StructType([T.StructField("request_id", T.LongType()), *ROUTED_ROW.fields])
    results = _router(spark, sf)
    path = _write_documents(spark, results.select("request_id", F.struct(*row.names).alias("row")), "router")
    calls = runs.explode_calls(runs.read_run_document(spark, path, row))
    return calls.select(
        "request_id", "route", "call_no", "model", "label", "confidence", "input_tokens", "output_tokens", "latency_ms"
    )


def _write_documents(spark, rows, mode):
    """Documents ``{mode, config, results}`` of up to 4,000 requests each: (request_id, row)."""
    path = shared_folder(spark, "documents")
    key = F.col("request_id")
    placed = rows.withColumn("doc", F.floor(key / 4000)).filter("doc is not null")
    # one shuffle: the rows of a document in order, its head before the first, its foot after the last
    order = W.partitionBy("doc").orderBy("request_id")
    head = f'{{"mode": "{mode}", "config": {{"note": "}} \\" ]", "list": [1, 2]}}, "results": [\n'
    begin = F.when(F.lag(F.lit(1)).over(order).isNull(), head).otherwise(",")
    end = F.when(F.lead(F.lit(1)).over(order).isNull(), "\n]}").otherwise("")
    lines = placed.select("doc", F.concat(begin, F.to_json("row", {"ignoreNullFields": "false"}), end).alias("value"))
    lines.select("doc", "value").write.partitionBy("doc").text(path)
    return path


@query(
    "baseline_document",
    with_ctes(["replies"], "SELECT 'present' AS document, round_even(avg(correct::int), 6) AS accuracy FROM base UNION ALL SELECT 'absent', NULL", BASE_SQL),
)
def baseline_document(spark, sf):
    """Accuracy of a stored baseline run, and what an absent one gives."""
    rows = baseline_rows(spark, sf).withColumn("user", F.col("user").substr(1, 40))
    row = F.struct("user", "expected", F.col("raw_reply"), F.col("final_label").alias("normalized"), "format_ok", "correct")
    path = _write_documents(spark, rows.select("request_id", row.alias("row")), "baseline")
    some = runs.baseline_metrics(spark, path).withColumn("document", F.lit("present"))
    none = runs.baseline_metrics(spark, f"{path}/absent").agg(F.max("accuracy").alias("accuracy")).withColumn("document", F.lit("absent"))
    return some.unionByName(none).select("document", half_even(F.col("accuracy")).alias("accuracy"))


_CHEAP = {"cheap_only": "SELECT * FROM singles WHERE run_id = 'cheap'", "strong_only": "SELECT * FROM singles WHERE run_id = 'strong'"}


def _cheap_only(spark, sf):
    return t.single_model(*_inputs(spark, sf, "cheap"), "cheap")


def _strong_only(spark, sf):
    return t.single_model(*_inputs(spark, sf, "strong"), "strong")


@query(
    "run_join",
    _check(
        """SELECT r.request_id, r.route, r.final_label, c.final_label AS other_label, r.correct, c.correct AS other_correct
        FROM router r JOIN cheap_only c USING (request_id)""",
        _CHEAP,
    ),
)
def run_join(spark, sf):
    return compare.run_join(_router(spark, sf), _cheap_only(spark, sf)).select(
        "request_id", "route", "final_label", "other_label", "correct", "other_correct"
    )


@query(
    "run_join_by_text",
    _check(
        """SELECT r.request_id, r.final_label, c.final_label AS other_label FROM router r JOIN (
          SELECT "user", arg_max({'l': final_label}, request_id).l AS final_label FROM cheap_only GROUP BY 1) c USING ("user")""",
        _CHEAP,
    ),
)
def run_join_by_text(spark, sf):
    """Runs matched on the request text: the last row of a repeated text counts."""
    cheap = compare.last_per_text(_cheap_only(spark, sf).select("user", "request_id", "final_label", "correct"), "request_id")
    return compare.run_join_by_text(_router(spark, sf), cheap).select("request_id", "final_label", "other_label")


@query(
    "rescued_broken",
    _check(
        """SELECT r.request_id, CASE WHEN r.correct THEN 'rescued' ELSE 'broken' END AS outcome, r.expected,
        c.final_label AS cheap_label, r.final_label, r."user"[:60] AS preview FROM router r JOIN cheap_only c USING (request_id)
        WHERE r.kind = 'holdout' AND r.route = 'escalated' AND r.correct <> c.correct""",
        _CHEAP,
    ),
)
def rescued_broken(spark, sf):
    return compare.rescued_broken(_router(spark, sf), _cheap_only(spark, sf))


@query(
    "run_agreement",
    _check(
        f"""SELECT count(*) AS total, {where('r.final_label IS NOT DISTINCT FROM s.final_label')} AS same,
        {share(where('r.final_label IS NOT DISTINCT FROM s.final_label'))} AS agreement FROM router r
        LEFT JOIN strong_only s USING (request_id)""",
        _CHEAP,
    ),
)
def run_agreement(spark, sf):
    """All router rows against the strong run."""
    return compare.run_agreement(_router(spark, sf), _strong_only(spark, sf))


_OUTCOME = """CASE WHEN m.correct AND c.correct THEN 'both' WHEN m.correct THEN 'first_only'
    WHEN c.correct THEN 'second_only' ELSE 'neither' END"""


@query(
    "outcome_matrix",
    _check(
        f"""SELECT o.outcome, count(x.request_id) AS n FROM (VALUES ('both'), ('first_only'), ('second_only'), ('neither'), ('unmatched')) AS o(outcome)
        LEFT JOIN (SELECT m.request_id, {_OUTCOME} AS outcome FROM microed m JOIN cheap_only c USING (request_id)
          WHERE m.kind = 'holdout') x USING (outcome) GROUP BY 1""",
        _CHEAP,
    ),
)
def outcome_matrix(spark, sf):
    held = lambda df: df.filter(F.col("kind") == "holdout")
    return compare.outcome_matrix(held(_micro(spark, sf)), held(_cheap_only(spark, sf)))


@query(
    "outcome_examples",
    _check(
        f"""SELECT * FROM (SELECT {_OUTCOME} AS outcome, cast(row_number() OVER (PARTITION BY {_OUTCOME} ORDER BY m.request_id) AS int) AS rank,
          m.request_id, m.expected, m.final_label, c.final_label AS other_label, m."user"[:80] AS preview
        FROM microed m JOIN cheap_only c USING (request_id) WHERE m.kind = 'holdout') WHERE rank <= 5""",
        _CHEAP,
    ),
)
def outcome_examples(spark, sf):
    micro = _micro(spark, sf).filter(F.col("kind") == "holdout")
    return compare.outcome_examples(micro, _cheap_only(spark, sf), 5)


@query(
    "best_of_two",
    _check(
        f"""SELECT request_id, CASE WHEN esc THEN 'escalated' ELSE 'cheap' END AS route,
        CASE WHEN NOT esc OR (coalesce(c.label IN {CLASSES}, false) AND (coalesce(c.confidence > s.confidence, false) OR NOT coalesce(s.label IN {CLASSES}, false)))
          THEN c.label ELSE s.label END AS final_label FROM joined"""
    ),
)
def best_of_two(spark, sf):
    return t.best_of_two(*_inputs(spark, sf, "cheap", "strong")).select("request_id", "route", "final_label")


_BY_CLASS = {"search": 0.95, "understand": 0.95, "modify": 0.7}
_LIMIT = "CASE c.label " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _BY_CLASS.items()) + " ELSE 0.85 END"


@query(
    "per_class_threshold",
    _check(
        f"""SELECT request_id, CASE WHEN e THEN 'escalated' ELSE 'cheap' END AS route,
        CASE WHEN e THEN s.label ELSE c.label END AS final_label FROM (SELECT *, {_unsure('c', _LIMIT)} AS e FROM joined)"""
    ),
)
def per_class_threshold(spark, sf):
    below = t.class_thresholds(F.col("cheap__label"), _BY_CLASS)
    return _router(spark, sf, below=below).select("request_id", "route", "final_label")


@query(
    "three_tier_route",
    _check(
        f"""SELECT request_id, CASE WHEN e2 THEN 'strong' WHEN e1 THEN 'mid' ELSE 'cheap' END AS route,
        CASE WHEN e2 THEN s.label WHEN e1 THEN m.label ELSE c.label END AS final_label,
        {_made(('c', 'true'), ('m', 'e1'), ('s', 'e2'))} AS n_calls,
        round_even({_added('cost', ('c', 'true'), ('m', 'e1'), ('s', 'e2'))}, 9) AS total_cost
        FROM (SELECT j.*, m AS m, esc AS e1, esc AND {_unsure('m')} AS e2 FROM joined j LEFT JOIN mid m USING (request_id))"""
    ),
)
def three_tier_route(spark, sf):
    out = t.three_tier(*_inputs(spark, sf, "cheap", "mid", "strong"))
    return _shown(out).select("request_id", "route", "final_label", "n_calls", "total_cost")


@query(
    "reply_doubt_route",
    _check(
        f"""SELECT request_id, CASE WHEN e THEN 'escalated' ELSE 'cheap' END AS route,
        CASE WHEN e THEN s.label ELSE c.label END AS final_label, {_made(('c', 'true'), ('d', 'true'), ('s', 'e'))} AS n_calls FROM (
          SELECT j.*, d AS d, j.c.label IS DISTINCT FROM d.label OR coalesce(length(j.c.raw) > 48 OR j.c.label NOT IN {CLASSES}, true) AS e
          FROM joined j LEFT JOIN cheap2 d USING (request_id))"""
    ),
)
def reply_doubt_route(spark, sf):
    out = t.reply_doubt(*_inputs(spark, sf, "cheap", "cheap2", "strong"), max_chars=48)
    return out.select("request_id", "route", "final_label", "n_calls")


@query("micro_route", _check(f"SELECT {_SHOWN}, micro_label, max_proba FROM microed"))
def micro_route(spark, sf):
    return _shown(_micro(spark, sf), "micro_label", "max_proba")


@query(
    "noise_filter",
    _check(
        """SELECT request_id, CASE WHEN e THEN 'escalated' ELSE 'stayed' END AS route,
        CASE WHEN e THEN f.label ELSE m.micro_label END AS final_label FROM (
          SELECT q.request_id, m AS m, f AS f, coalesce(m.max_proba < 0.6, true) OR coalesce(length(q."user") < 12, false) OR coalesce(m.max_proba > 0.95, false) AS e
          FROM requests q LEFT JOIN (SELECT * FROM micro WHERE """
        + _EMBEDDED
        + """) m USING (request_id) LEFT JOIN fallback f USING (request_id))"""
    ),
)
def noise_filter(spark, sf):
    noisy = t.noisy_input(F.col("user"), F.col("max_proba"))
    return _micro(spark, sf, noisy=noisy).select("request_id", "route", "final_label")


@query(
    "threshold_sweep",
    _check(
        f"""SELECT t::double / 10 AS threshold, {where('coalesce(max_proba >= t::double / 10, false)')} AS stay,
        {where('CASE WHEN max_proba >= t::double / 10 THEN micro_label ELSE fallback_label END = expected')} AS n_correct,
        {where('coalesce(max_proba < t::double / 10, true) AND NOT fallback_called')} AS unknown, count(*) AS total,
        {share(where('CASE WHEN max_proba >= t::double / 10 THEN micro_label ELSE fallback_label END = expected'))} AS accuracy
        FROM microed CROSS JOIN range(4, 10) AS r(t) GROUP BY t"""
    ),
)
def threshold_sweep(spark, sf):
    return t.threshold_sweep(_micro(spark, sf))


@query(
    "escalation_regret",
    _check(
        f"""SELECT count(*) AS total, {where("route = 'escalated' AND micro_label = expected")} AS needless,
        {where("route = 'stayed' AND micro_label <> expected")} AS lost FROM microed"""
    ),
)
def escalation_regret(spark, sf):
    return t.escalation_regret(_micro(spark, sf))


@query(
    "active_learning",
    _check(
        """SELECT request_id, kind, expected, micro_label, max_proba FROM microed
        WHERE micro_label <> expected AND max_proba > 0.6""",
        {k: RUNS_SQL[k].replace(f" AND {_RECORDED}", "").replace(f" WHERE {_EMBEDDED}", "") for k in ("fallback", "microed")},
    ),
)
def active_learning(spark, sf):
    return t.active_learning(_whole_micro(spark, sf))
