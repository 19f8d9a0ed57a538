"""Replaying routing decisions over recorded replies."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import ESCALATE_BELOW, INTENTS, PRICES, STAY_AT
from replyloom.functions.numeric import call_cost, embed_cost, half_even, nanos, ratio, usd_from_nanos
from replyloom.functions.replies import with_reply
from replyloom.functions.text import in_domain
from replyloom.operators.common import counted, is_adversarial, is_holdout, long_form, right
from replyloom.operators.gate_report import threshold_curve
from replyloom.operators.quantiles import with_percentiles
from replyloom.session import cut_lineage

CALL_FIELDS = ("model", "label", "confidence", "raw", "latency_ms", "input_tokens", "output_tokens")


def with_cost(replies: DataFrame, prices=PRICES) -> DataFrame:
    """Add ``cost`` and flag calls whose model has no price instead of failing."""
    cost = call_cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens"), prices)
    return replies.withColumn("cost", cost).withColumn("unknown_model", ~in_domain(F.col("model"), tuple(prices)))


class Call:
    """The columns of one call, by field. Calls stay flat columns ``<run>__<field>``
    and not structs, so that a shuffle carries the fields in use only: summaries do
    not move reply texts."""

    def __init__(self, field: Callable[[str], Column]):
        self._field = field

    def __getitem__(self, name: str) -> Column:
        return self._field(name)

    @property
    def present(self) -> Column:
        """Whether the call is recorded."""
        return F.coalesce(self["there"], F.lit(False))


def call(run_id: str) -> Call:
    return Call(lambda name: F.col(f"{run_id}__{name}"))


def either(cond: Column, first: Call, second: Call) -> Call:
    return Call(lambda name: F.when(cond, first[name]).otherwise(second[name]))


def read_runs(replies: DataFrame, runs, *, strict: bool = False, prices=PRICES, classes=INTENTS) -> DataFrame:
    """The JSON calls of several runs, a row per request with the columns of each run's call.

    Replies are read once, whatever the number of runs, and dealt out by request once; the
    grouping and a join that follows use that order. Fields nobody asks for are not moved. A run's
    (request, call) pairs are unique, see ``latest_calls`` otherwise.
    """
    wanted = replies.filter(F.col("run_id").isin(*runs))
    parsed = with_cost(with_reply(wanted, "raw", strict=strict, classes=classes), prices)
    fields = (*CALL_FIELDS, "cost")
    dealt = parsed.select("request_id", F.col("run_id").alias("_run"), *fields).repartition("request_id")
    of = lambda run, c: F.max(F.when(F.col("_run") == run, c))
    return dealt.groupBy("request_id").agg(
        *[of(run, F.col(f)).alias(f"{run}__{f}") for run in runs for f in fields],
        *[of(run, F.lit(True)).alias(f"{run}__there") for run in runs],
    )


def latest_calls(replies: DataFrame, position: str) -> DataFrame:
    """Keep the last recorded row of a repeated (run, request, call)."""
    key = ["run_id", "request_id", "call_no"]
    rest = [c for c in replies.columns if c not in key]
    best = replies.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(position)).alias("_r"))
    return best.select(*key, "_r.*").select(*replies.columns)


def with_tiers(requests: DataFrame, replies: DataFrame, runs, **kw) -> DataFrame:
    """All requests, each with the call of each run where it is recorded: one join for all runs."""
    return requests.join(read_runs(replies, runs, **kw), "request_id", "left")


def unsure(reply: Call, below: Column | float = ESCALATE_BELOW, classes=INTENTS) -> Column:
    """Confidence under the threshold, not a number, or a label outside the domain."""
    low = reply["confidence"] < (F.lit(below) if isinstance(below, (int, float)) else below)
    return F.coalesce(low, F.lit(True)) | ~in_domain(reply["label"], classes)


def _entry(reply: Call) -> Column:
    return F.struct(*[reply[f].alias(f) for f in CALL_FIELDS])


def _outcome(
    run_id: str, route: Column, final: Call, calls: list[Call], taken: list[Column] | None = None,
    cheap: Call | None = None, keep_calls: bool = True,
) -> dict[str, Column]:
    """The decision columns of a result row; ``taken`` says which calls the route asks for.
    What is not recorded adds nothing and is counted in ``n_missing``; a request without any
    recorded call has a NULL label, cost and latency."""
    taken = taken or [F.lit(True)] * len(calls)
    made = [t & c.present for t, c in zip(taken, calls)]
    zero = F.lit(0.0)
    add = lambda name: F.when(functools.reduce(operator.or_, made), sum(F.when(m, c[name]).otherwise(zero) for c, m in zip(calls, made)))
    nul = F.lit(None)
    out = {
        "run_id": F.lit(run_id),
        "route": route,
        "final_label": final["label"],
        "final_confidence": final["confidence"],
        "cheap_label": cheap["label"] if cheap is not None else nul.cast("string"),
        "cheap_confidence": cheap["confidence"] if cheap is not None else nul.cast("double"),
    }
    if keep_calls:
        out["calls"] = F.array_compact(F.array(*[F.when(m, _entry(c)) for c, m in zip(calls, made)]))
    out["n_calls"] = sum(m.cast("int") for m in made)
    out["n_missing"] = sum((t & ~c.present).cast("int") for t, c in zip(taken, calls))
    out["n_unpriced"] = sum((m & c["cost"].isNull()).cast("int") for m, c in zip(made, calls))
    out["total_cost"] = add("cost")
    out["total_latency_ms"] = add("latency_ms")
    return out


def _results(df: DataFrame, requests: DataFrame, outcome: dict[str, Column]) -> DataFrame:
    out = df.select(*requests.columns, *[c.alias(n) for n, c in outcome.items()])
    return out.withColumn("correct", right())


def single_model(requests: DataFrame, replies: DataFrame, run_id: str, **kw) -> DataFrame:
    """One model answers everything; its name is the route (NULL where nothing is recorded)."""
    df = with_tiers(requests, replies, [run_id], **kw)
    only = call(run_id)
    return _results(df, requests, _outcome(run_id, only["model"], only, [only]))


def _fallback(cheap: Call, strong: Call, escalated: Column) -> tuple[Column, Call]:
    route = F.when(escalated, F.lit("escalated")).otherwise(F.lit("cheap"))
    return route, either(escalated, strong, cheap)


def route_replay(
    requests: DataFrame,
    replies: DataFrame,
    *,
    cheap: str = "cheap",
    strong: str = "strong",
    below: float | Column = ESCALATE_BELOW,
    escalate: Column | None = None,
    run_id: str = "router",
    **kw,
) -> DataFrame:
    """Cheap reply kept unless unsure, else the strong reply as it is, valid or
    not. Every request is a row: one without a cheap reply escalates, one without the
    reply its route asks for has a NULL label. ``escalate`` replaces the
    rule with any predicate over the cheap call."""
    c, s, esc = call(cheap), call(strong), F.col("_esc")
    df = with_tiers(requests, replies, [cheap, strong], **kw)
    df = df.withColumn("_esc", unsure(c, below) if escalate is None else escalate)
    route, final = _fallback(c, s, esc)
    return _results(df, requests, _outcome(run_id, route, final, [c, s], [F.lit(True), esc], c))


def replay_modes(
    requests: DataFrame, replies: DataFrame, *, cheap="cheap", strong="strong", below=ESCALATE_BELOW,
    keep_calls: bool = False, **kw
) -> DataFrame:
    """Cheap-only, strong-only and routed results from one join: both reply sets
    are read once and each request fans out into its three outcomes, answered or not. The fan-out
    takes its rows whole, so the calls with their texts are left out unless asked
    for."""
    df = with_tiers(requests, replies, [cheap, strong], **kw)
    c, s = call(cheap), call(strong)
    df = df.withColumn("_esc", unsure(c, below))
    esc = F.col("_esc")
    route, final = _fallback(c, s, esc)
    row = lambda *a: F.struct(*[col.alias(n) for n, col in _outcome(*a, keep_calls=keep_calls).items()])
    outcomes = F.array(
        row(cheap, c["model"], c, [c]),
        row(strong, s["model"], s, [s]),
        row("router", route, final, [c, s], [F.lit(True), esc], c),
    )
    out = df.select(*requests.columns, F.inline(outcomes))
    return out.withColumn("correct", right())


def best_of_two(requests: DataFrame, replies: DataFrame, *, cheap="cheap", strong="strong", below=ESCALATE_BELOW, **kw) -> DataFrame:
    """After an escalation keep whichever valid answer is more confident; the
    strong one on a tie."""
    df = with_tiers(requests, replies, [cheap, strong], **kw)
    c, s = call(cheap), call(strong)
    df = df.withColumn("_esc", unsure(c, below))
    esc = F.col("_esc")
    keep = in_domain(c["label"]) & (
        F.coalesce(c["confidence"] > s["confidence"], F.lit(False)) | ~in_domain(s["label"])
    )
    route, _ = _fallback(c, s, esc)
    final = either(~esc | keep, c, s)
    return _results(df, requests, _outcome("best_of_two", route, final, [c, s], [F.lit(True), esc], c))


def class_thresholds(label: Column, thresholds: dict[str, float], default: float = ESCALATE_BELOW) -> Column:
    out = F.lit(float(default))
    for name, t in thresholds.items():
        out = F.when(label == name, F.lit(float(t))).otherwise(out)
    return out


def three_tier(
    requests: DataFrame, replies: DataFrame, *, tiers=("cheap", "mid", "strong"), below=ESCALATE_BELOW, **kw
) -> DataFrame:
    """Cheap, then middle, then strong, each only if the one before is unsure."""
    df = with_tiers(requests, replies, tiers, **kw)
    a, b, c = (call(t) for t in tiers)
    df = df.withColumn("_e1", unsure(a, below)).withColumn("_e2", F.col("_e1") & unsure(b, below))
    e1, e2 = F.col("_e1"), F.col("_e2")
    route = F.when(e2, F.lit(tiers[2])).when(e1, F.lit(tiers[1])).otherwise(F.lit(tiers[0]))
    final = either(e2, c, either(e1, b, a))
    return _results(df, requests, _outcome("three_tier", route, final, [a, b, c], [F.lit(True), e1, e2], a))


def reply_doubt(
    requests: DataFrame, replies: DataFrame, *, cheap="cheap", second="cheap2", strong="strong", max_chars: int = 60, **kw
) -> DataFrame:
    """Escalate when two cheap replies disagree or the reply is longer than an
    answer should be."""
    df = with_tiers(requests, replies, [cheap, second, strong], **kw)
    c, d, s = call(cheap), call(second), call(strong)
    differ = ~c["label"].eqNullSafe(d["label"])
    df = df.withColumn("_esc", differ | (F.length(c["raw"]) > max_chars) | ~in_domain(c["label"]))
    esc = F.col("_esc")
    route, final = _fallback(c, s, esc)
    return _results(df, requests, _outcome("reply_doubt", route, final, [c, d, s], [F.lit(True), F.lit(True), esc], c))


def micro_route(
    requests: DataFrame,
    micro: DataFrame,
    replies: DataFrame,
    *,
    fallback: str = "cheap",
    stay_at: float = STAY_AT,
    noisy: Column | None = None,
    prices=PRICES,
) -> DataFrame:
    """Small-model-first routing. ``micro(request_id, micro_label, max_proba,
    embed_tokens, embed_latency_ms)``; at or above ``stay_at`` its label stands,
    below it the fallback's (NULL when unusable) does. ``noisy`` sends further
    rows to the fallback whatever the probability. Every request is a row: one the small model
    has not seen goes to the fallback, one without a recorded fallback has a NULL label."""
    esc = ~F.coalesce(F.col("max_proba") >= stay_at, F.lit(False))
    if noisy is not None:
        esc = esc | F.coalesce(noisy, F.lit(False))
    df = with_tiers(requests.join(micro, "request_id", "left"), replies, [fallback], strict=True, prices=prices).withColumn("_esc", esc)
    f, esc = call(fallback), F.col("_esc")
    called = esc & f.present
    embed = F.coalesce(embed_cost(F.col("embed_tokens")), F.lit(0.0))
    zero = F.lit(0.0)
    llm = F.when(called, f["cost"]).otherwise(zero)
    return df.select(
        *requests.columns,
        F.lit("micro").alias("run_id"),
        F.when(esc, F.lit("escalated")).otherwise(F.lit("stayed")).alias("route"),
        F.when(esc, f["label"]).otherwise(F.col("micro_label")).alias("final_label"),
        F.when(esc, f["confidence"]).otherwise(F.col("max_proba")).alias("final_confidence"),
        "micro_label",
        "max_proba",
        F.when(esc, f["label"]).alias("fallback_label"),
        called.alias("fallback_called"),
        called.cast("int").alias("n_calls"),
        (esc & ~f.present).cast("int").alias("n_missing"),
        (called & f["cost"].isNull()).cast("int").alias("n_unpriced"),
        embed.alias("embed_cost"),
        llm.alias("llm_cost"),
        (embed + llm).alias("total_cost"),
        F.when(
            F.col("embed_latency_ms").isNotNull() | called, F.coalesce("embed_latency_ms", zero) + F.when(called, f["latency_ms"]).otherwise(zero)
        ).alias("total_latency_ms"),
    ).withColumn("correct", right())


ROUTES = ("cheap", "stayed", "escalated")


def micro_summary(results: DataFrame, by: list[str] = ["run_id"]) -> DataFrame:
    """The run summary of small-model-first results with what is known of both parts."""
    ok, up = F.col("correct"), F.col("route") == "escalated"
    return run_summary(results, by, {
        "stayed_correct": F.count_if(ok & ~up), "escalated_correct": F.count_if(ok & up), "adv_correct": F.count_if(ok & is_adversarial()),
        "n_llm_calls": F.sum("n_calls"), "embed_cost_usd": F.sum(nanos(F.col("embed_cost"))), "llm_cost_usd": F.sum(nanos(F.col("llm_cost"))),
    })


def run_summary(results: DataFrame, by: list[str] = ["run_id"], more: dict[str, Column] | None = None, routes=ROUTES) -> DataFrame:
    """Totals, accuracy counts, rows of each of ``routes``, calls, cost and index percentiles of
    each run. Calls without a price are in no cost; ``n_unpriced`` tells how many, and ``n_missing``
    how many calls a route asked for are not recorded; their requests count in every total. Rows are
    grouped once, by run and whole millisecond; that histogram is written, and sums and percentiles are
    made from it. ``more`` names further sums; those ending in ``_usd`` are in billionths."""
    ok, h = F.col("correct"), is_holdout()
    more = more or {}
    optional = lambda name: F.sum(name) if name in results.columns else F.lit(0).cast("bigint")
    hist = results.groupBy(*by, F.rint("total_latency_ms").cast("bigint").alias("ms")).agg(
        F.count(F.lit(1)).alias("_c"),
        F.count_if(h).alias("_h"),
        F.count_if(is_adversarial()).alias("_a"),
        F.count_if(ok).alias("_ok"),
        F.count_if(ok & h).alias("_hok"),
        F.count_if(F.col("route") == "escalated").alias("_e"),
        F.sum("n_calls").alias("_calls"),
        F.sum(nanos(F.col("total_cost"))).alias("_cost"),
        optional("n_unpriced").alias("_unpriced"),
        optional("n_missing").alias("_missing"),
        *[F.count_if(F.col("route") == r).alias(f"_r{i}") for i, r in enumerate(routes)],
        *[c.alias(f"_m_{n}") for n, c in more.items()],
    )
    hist = cut_lineage(hist, "summary")
    sums = counted(
        by,
        hist,
        F.sum("_c").alias("total"),
        F.sum("_h").alias("holdout_total"),
        F.sum("_a").alias("adv_total"),
        F.sum("_ok").alias("correct_total"),
        F.sum("_hok").alias("holdout_correct"),
        F.sum("_e").alias("escalated"),
        F.sum("_calls").alias("api_calls"),
        F.sum("_unpriced").alias("n_unpriced"),
        F.sum("_missing").alias("n_missing"),
        *[F.sum(f"_r{i}").alias(f"route_{r}") for i, r in enumerate(routes)],
        *[(usd_from_nanos(F.sum(f"_m_{n}")) if n.endswith("_usd") else F.sum(f"_m_{n}")).alias(n) for n in more],
        usd_from_nanos(F.sum("_cost")).alias("total_cost_usd"),
    )
    return with_percentiles(sums, hist, by)


def headline(summary: DataFrame) -> DataFrame:
    """The run comparison table; adversarial figures are the remainder."""
    return summary.select(
        "run_id",
        "holdout_correct",
        "holdout_total",
        half_even(ratio(F.col("holdout_correct"), F.col("holdout_total"))).alias("holdout_accuracy"),
        (F.col("correct_total") - F.col("holdout_correct")).alias("adv_correct"),
        (F.col("total") - F.col("holdout_total")).alias("adv_total"),
        half_even(ratio(F.col("correct_total"), F.col("total"))).alias("total_accuracy"),
        "api_calls",
        "total_cost_usd",
        "latency_p50_ms",
        "latency_p95_ms",
    )


def route_distribution(results: DataFrame, routes=("cheap", "escalated")) -> DataFrame:
    one = results.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("route") == r).alias(r) for r in routes]
    )
    return long_form(
        one,
        ["total"],
        [[("route", F.lit(r)), ("n", F.col(r)), ("share", half_even(ratio(F.col(r), F.col("total"))))] for r in routes],
    )


def route_accuracy(results: DataFrame) -> DataFrame:
    return results.groupBy("run_id", "route").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("correct").alias("n_correct"),
        half_even(ratio(F.count_if("correct"), F.count(F.lit(1)))).alias("accuracy"),
    )


def escalation_by_class(results: DataFrame, classes=INTENTS) -> DataFrame:
    """Kept and escalated counts by holdout class and by adversarial kind, in one
    grouping: a holdout row's group is its class, another's its kind. A class without
    rows is there with zeros."""
    group = F.when(is_holdout(), F.col("expected")).otherwise(F.col("kind"))
    rows = results.filter(is_holdout() | is_adversarial()).select(
        F.when(is_holdout(), F.lit("class")).otherwise(F.lit("kind")).alias("by"), group.alias("value"), (F.col("route") == "escalated").alias("_esc"), F.lit(1).alias("_n")
    )
    every = results.sparkSession.createDataFrame([("class", c, False, 0) for c in classes], "by string, value string, _esc boolean, _n int")
    esc, n = F.count_if("_esc"), F.sum("_n")
    return rows.unionByName(every).groupBy("by", "value").agg(
        (n - esc).alias("kept"), esc.alias("escalated"), half_even(ratio(esc, n)).alias("escalated_share")
    )


def cost_saving(summary: DataFrame, run_id: str, against) -> DataFrame:
    """Saving and cost ratio of one run against others. A summary has a row per run."""
    mine = summary.filter(F.col("run_id") == run_id).agg(F.max("total_cost_usd").alias("run_cost"))
    cost = mine.scalar()
    return summary.filter(F.col("run_id").isin(*against)).select(
        F.col("run_id").alias("base_run"),
        F.col("total_cost_usd").alias("base_cost"),
        cost.alias("run_cost"),
    ).select(
        "*",
        half_even(ratio(F.col("base_cost") - F.col("run_cost"), F.col("base_cost"), None)).alias("saving"),
        half_even(ratio(F.col("run_cost"), F.col("base_cost"), None)).alias("cost_ratio"),
    )


def threshold_sweep(micro_results: DataFrame, thresholds=(0.4, 0.5, 0.6, 0.7, 0.8, 0.9)) -> DataFrame:
    """What other stay thresholds would have given. A request that would escalate
    but has no recorded fallback counts as wrong and as ``unknown``."""
    curve = threshold_curve(
        micro_results,
        F.col("max_proba"),
        thresholds,
        {"stay": F.lit(True), "_sr": right("micro_label")},
        {"_down": F.lit(True), "_fr": right("fallback_label"), "unknown": ~F.col("fallback_called")},
    )
    n_right, total = F.col("_sr") + F.col("_fr"), F.col("stay") + F.col("_down")
    return curve.select(
        "threshold", "stay", n_right.alias("n_correct"), "unknown", total.alias("total"),
        half_even(ratio(n_right, total)).alias("accuracy"),
    )


def escalation_regret(micro_results: DataFrame) -> DataFrame:
    """Needless escalations (the small model was right) and lost rows (it stayed,
    confident and wrong)."""
    up, ok = F.col("route") == "escalated", right("micro_label")
    return micro_results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(up & ok).alias("needless"),
        F.count_if(~up & ~ok).alias("lost"),
    )


def active_learning(micro_results: DataFrame, above: float = STAY_AT) -> DataFrame:
    """Confidently wrong small-model answers: the rows worth labelling next."""
    return micro_results.filter(~right("micro_label") & (F.col("max_proba") > above)).select(
        "request_id", "kind", "expected", "micro_label", "max_proba"
    )


def noisy_input(text: Column, proba: Column, min_chars: int = 12, too_sure: float = 0.95) -> Column:
    """Too short a text or too certain a small model."""
    return (F.length(text) < min_chars) | F.coalesce(proba > too_sure, F.lit(False))
