"""Queries: the acceptance gate and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyloom.functions.replies import with_reply
from replyloom.functions.text import normalize_reply
from replyloom.operators import gate as g, gate_report as r, metrics, models
from replyloom.operators.common import is_holdout, right
from replyloom.plans import derive as d
from replyloom.plans.registry import query, with_ctes
from replyloom.plans.reply_queries import _scored
from replyloom.plans.sqltext import CLASS_ROWS, CLASSES, normal, parsed, share, strict, where


def _gated(spark, sf):
    reqs = d.requests(spark, sf)
    return g.gate(d.slim(reqs), d.replies(reqs, "gate"))


_CALL3 = "(SELECT * FROM replies WHERE run_id = 'gate' AND call_no = 3)"
GATE_SQL = {
    "wide": f"""SELECT q.request_id, q."user", q.expected, q.kind,
        {normal('a.raw')} AS p1, {normal('b.raw')} AS p2, c.label AS p3, c.confidence, c.parse_error,
        {strict('a.raw')} AND {strict('b.raw')} AND NOT c.parse_error AND c.label IN {CLASSES} AS format_ok,
        greatest(a.latency_ms, b.latency_ms, c.latency_ms) AS latency_ms_max,
        a.input_tokens + a.output_tokens + b.input_tokens + b.output_tokens + c.input_tokens + c.output_tokens AS tokens_total
      FROM requests q
      JOIN (SELECT * FROM replies WHERE run_id = 'gate' AND call_no = 1) a USING (request_id)
      JOIN (SELECT * FROM replies WHERE run_id = 'gate' AND call_no = 2) b USING (request_id)
      JOIN ({parsed(_CALL3)}) c USING (request_id)""",
    "ballots": f"""SELECT request_id, vote, min(pos) AS first_pos, count(*) AS n FROM (
        SELECT request_id, unnest([p1, p2, p3]) AS vote, unnest([1, 2, 3]) AS pos FROM wide)
      WHERE vote IN {CLASSES} GROUP BY 1, 2""",
    "tops": """SELECT request_id, arg_max(vote, n * 10 - first_pos) AS predicted, max(n) AS top_n, sum(n)::bigint AS n_valid
      FROM ballots GROUP BY 1""",
    "gated": """SELECT w.*, t.predicted, coalesce(t.top_n, 0) AS top_n, coalesce(t.n_valid, 0) AS n_valid,
      CASE WHEN t.top_n IS NULL THEN 'FAIL'
        WHEN t.top_n = 3 AND confidence >= 0.85 AND format_ok THEN 'OK'
        WHEN t.top_n = 3 AND confidence >= 0.5 THEN 'UNSURE'
        WHEN t.top_n = 2 THEN 'UNSURE'
        WHEN t.top_n = 1 AND t.n_valid = 3 THEN 'FAIL'
        WHEN confidence < 0.5 THEN 'FAIL'
        WHEN NOT format_ok THEN 'FAIL' ELSE 'UNSURE' END AS status,
      coalesce(t.predicted = expected, false) AS hit
      FROM wide w LEFT JOIN tops t USING (request_id)""",
    "held": "SELECT * FROM gated WHERE kind = 'holdout'",
}


def _check(body, extra=None, needs=()):
    return with_ctes(["replies", *needs], body, {**GATE_SQL, **(extra or {})})


@query(
    "gate",
    _check(
        """SELECT request_id, status, predicted, confidence, cast(top_n AS int) AS vote_top_count,
        cast(n_valid AS int) AS n_valid, format_ok, tokens_total, latency_ms_max FROM gated"""
    ),
)
def gate(spark, sf):
    return _gated(spark, sf).select(
        "request_id", "status", "predicted", "confidence", "vote_top_count", "n_valid", "format_ok",
        "tokens_total", "latency_ms_max",
    )


@query(
    "majority_vote",
    with_ctes(
        ["replies"],
        """SELECT request_id, arg_max(vote, n * 100 - first_pos) AS predicted, coalesce(max(n), 0) AS vote_top_count,
        coalesce(sum(n), 0)::bigint AS n_valid FROM requests LEFT JOIN b USING (request_id) GROUP BY 1""",
        {
            "b": f"""SELECT request_id, vote, min(pos) AS first_pos, count(*) AS n FROM (
            SELECT request_id, {normal('raw')} AS vote,
              CASE run_id WHEN 'baseline' THEN 0 WHEN 'gate' THEN call_no ELSE 5 END AS pos
            FROM replies WHERE stage = 'plain' AND run_id IN ('baseline', 'gate', 'tuned')
            UNION ALL SELECT request_id, label, 3 FROM ({parsed(_CALL3)}))
            WHERE vote IN {CLASSES} GROUP BY 1, 2"""
        },
    ),
)
def majority_vote(spark, sf):
    """Five votes per request, the gate's JSON vote among them, so ties happen."""
    is_json = F.col("stage") != "plain"
    rep = with_reply(d.replies(d.requests(spark, sf), "baseline", "gate", "tuned"), "raw", when=is_json)
    pos = F.when(F.col("run_id") == "baseline", F.lit(0)).when(F.col("run_id") == "gate", F.col("call_no")).otherwise(F.lit(5))
    vote = F.when(is_json, F.col("label")).otherwise(normalize_reply(F.col("raw")))
    votes = rep.select("request_id", pos.alias("call_no"), vote.alias("vote"))
    return g.majority_vote(votes)


@query(
    "gate_summary",
    _check(
        f"""SELECT count(*) AS total, {where("status = 'OK'")} AS n_ok, {where("status = 'UNSURE'")} AS n_unsure,
        {where("status = 'FAIL'")} AS n_fail, 3 * count(*) AS api_calls, cast(sum(tokens_total) AS bigint) AS tokens,
        list_sort(list(cast(round_even(latency_ms_max, 0) AS bigint)))[cast(floor(count(*) * 0.5::double) AS bigint) + 1] AS latency_p50_ms,
        list_sort(list(cast(round_even(latency_ms_max, 0) AS bigint)))[cast(floor(count(*) * 0.95::double) AS bigint) + 1] AS latency_p95_ms,
        round_even(cast(sum(tokens_total) AS bigint) / 1000000.0::double * 0.75::double / 2, 4) AS estimated_cost_usd FROM gated"""
    ),
)
def gate_summary(spark, sf):
    return r.gate_summary(_gated(spark, sf))


@query(
    "status_breakdown",
    _check(
        """SELECT subset, s.status, count(g.status) AS n,
        coalesce(round_even(count(g.status)::double / nullif(any_value(total), 0), 6), 0.0) AS share
        FROM (SELECT 'all' AS subset, (SELECT count(*) FROM gated) AS total
          UNION ALL SELECT 'holdout', (SELECT count(*) FROM held)
          UNION ALL SELECT 'adversarial', (SELECT count(*) FROM gated WHERE kind LIKE 'adv-%'))
        CROSS JOIN (VALUES ('OK'), ('UNSURE'), ('FAIL')) AS s(status)
        LEFT JOIN gated g ON g.status = s.status AND (subset = 'all' OR (subset = 'holdout') = (g.kind = 'holdout'))
        GROUP BY 1, 2"""
    ),
)
def status_breakdown(spark, sf):
    return r.status_breakdown(_gated(spark, sf))


@query(
    "class_status",
    _check(
        f"""SELECT c.label, {where("status = 'OK'")} AS n_ok, {where("status = 'UNSURE'")} AS n_unsure,
        {where("status = 'FAIL'")} AS n_fail FROM {CLASS_ROWS} LEFT JOIN held h ON h.expected = c.label GROUP BY 1"""
    ),
)
def class_status(spark, sf):
    return r.class_status(_gated(spark, sf))


_H, _A, _OK = "kind = 'holdout'", "kind LIKE 'adv-%'", "status = 'OK'"


@query(
    "gate_quality",
    _check(
        f"""SELECT {where(_H)} AS holdout_total, {where(_A)} AS adv_total, {where(f'{_H} AND {_OK}')} AS holdout_accepted,
        {where(f'{_H} AND {_OK} AND hit')} AS holdout_accepted_right, {where(f'{_A} AND {_OK}')} AS adv_accepted,
        {where(f'{_A} AND {_OK} AND hit')} AS adv_accepted_right, {where(f'{_H} AND NOT hit')} AS holdout_wrong,
        {where(f'{_H} AND NOT hit AND status <> ' + "'OK'")} AS holdout_caught,
        {share(where(f'{_H} AND {_OK} AND hit'), where(f'{_H} AND {_OK}'))} AS holdout_accepted_accuracy,
        {share(where(f'{_A} AND {_OK} AND hit'), where(f'{_A} AND {_OK}'))} AS adv_accepted_accuracy,
        {share(where(f'{_H} AND {_OK}'), where(_H))} AS pickup_rate,
        {share(where(f"{_A} AND status IN ('UNSURE', 'FAIL')"), where(_A))} AS rejection_rate,
        {share(where(f"{_H} AND NOT hit AND status <> 'OK'"), where(f'{_H} AND NOT hit'))} AS catch_rate FROM gated"""
    ),
)
def gate_quality(spark, sf):
    return r.gate_quality(_gated(spark, sf))


@query(
    "gated_vs_baseline",
    _check(
        f"""SELECT count(*) AS baseline_served, (SELECT round_even(avg(coalesce({normal('raw')} = expected, false)::int), 6) FROM requests
          LEFT JOIN (SELECT * FROM replies WHERE run_id = 'baseline' AND {d.RECORDED}) USING (request_id) WHERE kind = 'holdout') AS baseline_accuracy,
        {where(_OK)} AS gated_served, {share(where(f'{_OK} AND hit'), where(_OK))} AS gated_accuracy,
        count(*) - {where(_OK)} AS flagged FROM held"""
    ),
)
def gated_vs_baseline(spark, sf):
    base = metrics.accuracy(_scored(spark, sf).filter(is_holdout()))
    return r.gated_vs_baseline(_gated(spark, sf), base)


@query(
    "confidence_gap",
    _check(
        """SELECT round_even(a, 6) AS mean_right, round_even(b, 6) AS mean_wrong, round_even(a - b, 6) AS gap FROM (
        SELECT coalesce(avg(confidence) FILTER (hit), 0) AS a, coalesce(avg(confidence) FILTER (NOT hit), 0) AS b FROM held)"""
    ),
)
def confidence_gap(spark, sf):
    return r.confidence_gap(_gated(spark, sf))


@query(
    "signal_isolation",
    _check(
        """SELECT caught, signal, n FROM (SELECT count(*) AS caught,
          count(*) FILTER (NOT format_ok) AS format,
          count(*) FILTER (format_ok AND n_kinds > 1) AS vote_split,
          count(*) FILTER (confidence < 0.85) AS low_confidence,
          count(*) FILTER (p3 IN ('search', 'understand', 'describe', 'modify') AND p3 <> predicted) AS vote_vs_json
        FROM held LEFT JOIN (SELECT request_id, count(*) AS n_kinds FROM ballots GROUP BY 1) USING (request_id)
        WHERE NOT hit AND status <> 'OK') UNPIVOT (n FOR signal IN (format, vote_split, low_confidence, vote_vs_json))"""
    ),
)
def signal_isolation(spark, sf):
    return r.signal_isolation(_gated(spark, sf))


@query(
    "spearman",
    _check(
        """SELECT n, rho, CASE WHEN rho > 0.3 THEN 'useful' WHEN rho > 0 THEN 'weak' ELSE 'none' END AS verdict FROM (
        SELECT count(*) AS n, coalesce(round_even(corr(rx, ry), 6), 0.0) AS rho FROM (
          SELECT avg(i) OVER (PARTITION BY confidence) AS rx, avg(j) OVER (PARTITION BY hit) AS ry FROM (
            SELECT confidence, hit, row_number() OVER (ORDER BY confidence) AS i, row_number() OVER (ORDER BY hit) AS j
            FROM held WHERE confidence > 0)))"""
    ),
)
def spearman(spark, sf):
    return r.confidence_spearman(_gated(spark, sf))


@query(
    "adversarial_detail",
    _check(
        """SELECT request_id, kind, status, predicted, expected, round_even(confidence, 2) AS confidence
        FROM gated WHERE kind LIKE 'adv-%'"""
    ),
)
def adversarial_detail(spark, sf):
    return r.adversarial_detail(_gated(spark, sf))


@query(
    "two_level_gate",
    _check(
        f"""SELECT CASE WHEN confidence >= 0.95 THEN 'accept' WHEN confidence >= 0.7 THEN 'review' ELSE 'reject' END AS level,
        count(*) AS n, {where('hit')} AS n_right, {share(where('hit'))} AS accuracy FROM gated GROUP BY 1"""
    ),
)
def two_level_gate(spark, sf):
    return r.two_level_report(_gated(spark, sf))


@query(
    "baseline_catch",
    _check(
        f"""SELECT count(*) AS baseline_wrong, {where("status <> 'OK'")} AS flagged,
        {share(where("status <> 'OK'"))} AS catch_rate FROM held
        JOIN (SELECT request_id FROM requests LEFT JOIN (SELECT * FROM replies WHERE run_id = 'baseline' AND {d.RECORDED}) USING (request_id)
          WHERE coalesce({normal('raw')} <> expected, true)) USING (request_id)"""
    ),
)
def baseline_catch(spark, sf):
    return r.baseline_catch(_gated(spark, sf), _scored(spark, sf))


@query(
    "pr_curve",
    _check(
        f"""SELECT t::double / 20 AS threshold, {where('confidence >= t::double / 20')} AS accepted,
        {where('hit AND confidence >= t::double / 20')} AS accepted_right,
        {share(where('confidence >= t::double / 20'))} AS pickup,
        {share(where('hit AND confidence >= t::double / 20'), where('confidence >= t::double / 20'))} AS precision,
        {share(where('hit AND confidence >= t::double / 20'), where('hit'))} AS recall
        FROM held CROSS JOIN range(21) AS r(t) GROUP BY t"""
    ),
)
def pr_curve(spark, sf):
    return r.pr_curve(_gated(spark, sf).filter(is_holdout()), right("predicted"))


@query(
    "reliability_bins",
    _check(
        """SELECT cast(least(floor(confidence * 10), 9) AS int) AS bin, count(*) AS n,
        round_even(avg(confidence), 6) AS mean_confidence, round_even(avg(hit::int), 6) AS accuracy
        FROM held WHERE confidence BETWEEN 0 AND 1 GROUP BY 1"""
    ),
)
def reliability_bins(spark, sf):
    return r.reliability_bins(_gated(spark, sf).filter(is_holdout()), right("predicted"))


@query(
    "calibration",
    _check(
        """SELECT confidence, n, round_even(hits / n, 6) AS accuracy, round_even(fitted, 6) AS calibrated FROM (
          SELECT k.confidence, k.n, k.hits, max(s.low) AS fitted FROM pts k JOIN starts s ON s.i <= k.i AND s.k = k.i GROUP BY 1, 2, 3)""",
        {
            # isotonic value at k: the greatest over starts i <= k of the least over ends j >= k of the mean of i..j
            "pts": """SELECT *, row_number() OVER (ORDER BY confidence) AS i, sum(n) OVER (ORDER BY confidence) AS nn, sum(hits) OVER (ORDER BY confidence) AS hh FROM (
              SELECT confidence, count(*) AS n, (count(*) FILTER (hit))::double AS hits FROM held WHERE confidence IS NOT NULL GROUP BY 1)""",
            "starts": """SELECT a.i, k.i AS k, min((b.hh - a.hh + a.hits) / (b.nn - a.nn + a.n)) AS low
              FROM pts a JOIN pts k ON a.i <= k.i JOIN pts b ON b.i >= k.i GROUP BY 1, 2""",
        },
    ),
)
def calibration(spark, sf):
    """Isotonic map from self-reported confidence to accuracy."""
    return models.calibrate(_gated(spark, sf).filter(is_holdout()), right("predicted"))
