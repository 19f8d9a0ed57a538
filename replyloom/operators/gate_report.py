"""Reports over gated requests (status, predicted, expected, kind, confidence ...).

Each report is one pass with conditional aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replyloom.domain import ACCEPT_AT, INTENTS, STATUSES
from replyloom.functions.numeric import blended_cost, half_even, ratio
from replyloom.functions.text import domain_label
from replyloom.operators.common import is_adversarial, is_holdout, long_form, right
from replyloom.operators.gate import two_level_status
from replyloom.operators.quantiles import with_percentiles
from replyloom.session import cut_lineage


def _ok() -> Column:
    return F.col("status") == "OK"


def _hit() -> Column:
    return right("predicted")


def gate_summary(gated: DataFrame) -> DataFrame:
    """Totals, calls, tokens, estimated cost and index percentiles of the slowest
    of the parallel calls. Rows are grouped once, by whole millisecond; that histogram is written, and
    sums and percentiles are made from it."""
    hist = gated.groupBy(F.rint("latency_ms_max").cast("bigint").alias("ms")).agg(
        F.count(F.lit(1)).alias("_c"),
        *[F.count_if(F.col("status") == s).alias(f"_{s}") for s in STATUSES],
        F.sum("n_calls").alias("_calls"),
        F.sum("tokens_total").alias("_tokens"),
    )
    hist, tokens = cut_lineage(hist, "gate-summary"), F.sum("_tokens")
    sums = hist.agg(
        F.sum("_c").alias("total"),
        *[F.sum(f"_{s}").alias(f"n_{s.lower()}") for s in STATUSES],
        F.sum("_calls").alias("api_calls"),
        tokens.alias("tokens"),
        half_even(blended_cost(tokens), 4).alias("estimated_cost_usd"),
    )
    return with_percentiles(sums, hist, [])


def status_breakdown(gated: DataFrame) -> DataFrame:
    """Counts and shares per status over everything, holdout and adversarial."""
    subsets = {"all": F.lit(True), "holdout": is_holdout(), "adversarial": is_adversarial()}
    one = gated.agg(
        *[
            F.count_if(cond & (F.col("status") == s)).alias(f"{name}_{s}")
            for name, cond in subsets.items()
            for s in STATUSES
        ]
    )
    rows = []
    for name in subsets:
        total = sum(F.col(f"{name}_{s}") for s in STATUSES)
        for s in STATUSES:
            n = F.col(f"{name}_{s}")
            rows.append(
                [("subset", F.lit(name)), ("status", F.lit(s)), ("n", n), ("share", half_even(ratio(n, total)))]
            )
    return long_form(one, [], rows)


def class_status(gated: DataFrame, classes=INTENTS) -> DataFrame:
    """Holdout class by status, every class present."""
    one = gated.filter(is_holdout()).agg(
        *[
            F.count_if((F.col("expected") == c) & (F.col("status") == s)).alias(f"{c}_{s}")
            for c in classes
            for s in STATUSES
        ]
    )
    return long_form(
        one,
        [],
        [[("label", F.lit(c))] + [(f"n_{s.lower()}", F.col(f"{c}_{s}")) for s in STATUSES] for c in classes],
    )


def gate_quality(gated: DataFrame) -> DataFrame:
    """Accuracy on accepted, pickup, rejection and catch rates."""
    h, a, ok, hit = is_holdout(), is_adversarial(), _ok(), _hit()
    one = gated.agg(
        F.count_if(h).alias("holdout_total"),
        F.count_if(a).alias("adv_total"),
        F.count_if(h & ok).alias("holdout_accepted"),
        F.count_if(h & ok & hit).alias("holdout_accepted_right"),
        F.count_if(a & ok).alias("adv_accepted"),
        F.count_if(a & ok & hit).alias("adv_accepted_right"),
        F.count_if(h & ~hit).alias("holdout_wrong"),
        F.count_if(h & ~hit & ~ok).alias("holdout_caught"),
    )
    r = lambda x, y: half_even(ratio(F.col(x), F.col(y)))
    return one.select(
        "*",
        r("holdout_accepted_right", "holdout_accepted").alias("holdout_accepted_accuracy"),
        r("adv_accepted_right", "adv_accepted").alias("adv_accepted_accuracy"),
        r("holdout_accepted", "holdout_total").alias("pickup_rate"),
        half_even(ratio(F.col("adv_total") - F.col("adv_accepted"), F.col("adv_total"))).alias("rejection_rate"),
        r("holdout_caught", "holdout_wrong").alias("catch_rate"),
    )


def gated_vs_baseline(gated: DataFrame, baseline: DataFrame) -> DataFrame:
    """Served, accuracy on served and flagged, next to a baseline run's one-row
    ``accuracy``; an empty baseline leaves NULL."""
    one = gated.filter(is_holdout()).agg(
        F.count(F.lit(1)).alias("baseline_served"),
        F.count_if(_ok()).alias("gated_served"),
        F.count_if(_ok() & _hit()).alias("_right"),
    )
    return one.select(
        "baseline_served",
        baseline.agg(F.max("accuracy")).scalar().alias("baseline_accuracy"),
        "gated_served",
        half_even(ratio(F.col("_right"), F.col("gated_served"))).alias("gated_accuracy"),
        (F.col("baseline_served") - F.col("gated_served")).alias("flagged"),
    )


def confidence_gap(gated: DataFrame) -> DataFrame:
    """Mean confidence of right and wrong holdout predictions and their gap."""
    mean = lambda cond: F.coalesce(F.avg(F.when(cond, F.col("confidence"))), F.lit(0.0))
    one = gated.filter(is_holdout()).agg(mean(_hit()).alias("r"), mean(~_hit()).alias("w"))
    return one.select(
        half_even(F.col("r")).alias("mean_right"),
        half_even(F.col("w")).alias("mean_wrong"),
        half_even(F.col("r") - F.col("w")).alias("gap"),
    )


def signal_isolation(gated: DataFrame, accept_at: float = ACCEPT_AT) -> DataFrame:
    """Which signal caught the wrong holdout predictions. Format hides a split
    vote; low confidence counts on its own. ``vote_vs_json``: the JSON reply's
    valid class is not the vote's winner."""
    caught = gated.filter(is_holdout() & ~_hit() & ~_ok())
    codes = [F.col(f"code{n}") for n in (1, 2, 3)]
    valid = [F.when(c > 0, c) for c in codes]
    split = F.greatest(*valid) > F.least(*valid)
    json_label = domain_label(codes[2])
    one = caught.agg(
        F.count(F.lit(1)).alias("caught"),
        F.count_if(~F.col("format_ok")).alias("format"),
        F.count_if(F.col("format_ok") & split).alias("vote_split"),
        F.count_if(F.col("confidence") < accept_at).alias("low_confidence"),
        F.count_if(json_label != F.col("predicted")).alias("vote_vs_json"),
    )
    names = ("format", "vote_split", "low_confidence", "vote_vs_json")
    return long_form(one, ["caught"], [[("signal", F.lit(n)), ("n", F.col(n))] for n in names])


def spearman(df: DataFrame, value: str, hit: Column, steps: int = 256) -> DataFrame:
    """Rank correlation, ties averaged, of a number with a yes/no outcome.

    Rows collapse to one per distinct value, which take the average rank ``before +
    (c+1)/2``. Finding ``before`` needs a running count in value order; to keep
    that off a single task, quantile boundaries of the distinct values cut them
    into ``steps`` ranges of about equal size. Inside a range the running count is
    local. A range's offset enters its sums linearly, so only ``steps`` rows meet
    to finish: rank = offset + local, and the sums of w*rank and w*rank^2 expand.
    Boundaries and ranges are read from the same exchange of distinct values (the boundaries' row
    carries the totals that the last step needs), so rows are read and counted once.
    """
    hist = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("c"), F.count_if(hit).alias("p"))
    )
    marks = hist.agg(
        F.percentile_approx("v", [i / steps for i in range(1, steps)], steps * 40).alias("marks"), F.sum("c").alias("_n"), F.sum("p").alias("_hits")
    )
    # one row holding a fixed number of boundaries
    ranged = hist.join(F.broadcast(marks)).select(
        "v", "c", "p", F.size(F.filter("marks", lambda m: m < F.col("v"))).alias("b"), "_n", "_hits"
    )
    inside = W.partitionBy("b").orderBy("v")
    local = ranged.withColumn("r", F.sum("c").over(inside) - F.col("c") + (F.col("c") + 1) / F.lit(2.0))
    per_range = local.groupBy("b").agg(
        F.sum("c").alias("c"),
        F.sum("p").alias("p"),
        F.max("_n").alias("_n"),
        F.max("_hits").alias("_hits"),
        F.sum(F.col("c") * F.col("r")).alias("cr"),
        F.sum(F.col("c") * F.col("r") * F.col("r")).alias("crr"),
        F.sum(F.col("p") * F.col("r")).alias("pr"),
    )
    # at most ``steps`` rows from here on
    everything = W.orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)
    off = (F.sum("c").over(everything) - F.col("c")).cast("double")
    shifted = per_range.withColumn("o", off)
    tot = shifted.agg(
        F.max("_n").alias("n"),
        F.max("_hits").alias("P"),
        F.sum(F.col("cr") + F.col("o") * F.col("c")).alias("x"),
        F.sum(F.col("crr") + 2 * F.col("o") * F.col("cr") + F.col("o") * F.col("o") * F.col("c")).alias("xx"),
        F.sum(F.col("pr") + F.col("o") * F.col("p")).alias("xp"),
    )
    n, P = F.col("n").cast("double"), F.col("P").cast("double")
    N = n - P
    m = (n + 1) / 2
    low, high = (N + 1) / 2 - m, N + (P + 1) / 2 - m
    # sum over rows of (rank_x - m) * (rank_y - m)
    num = high * (F.col("xp") - m * P) + low * ((F.col("x") - F.col("xp")) - m * N)
    var_x = F.col("xx") - 2 * m * F.col("x") + n * m * m
    var_y = P * high * high + N * low * low
    root = F.sqrt(F.greatest(var_x, F.lit(0.0)) * F.greatest(var_y, F.lit(0.0)))
    usable = (n >= 2) & (P > 0) & (N > 0) & (root > 0)
    rho = F.when(usable, ratio(num, root)).otherwise(F.lit(0.0))
    return tot.select(F.coalesce("n", F.lit(0)).alias("n"), half_even(rho).alias("rho")).withColumn(
        "verdict",
        F.when(F.col("rho") > 0.3, F.lit("useful")).when(F.col("rho") > 0, F.lit("weak")).otherwise(F.lit("none")),
    )


def confidence_spearman(gated: DataFrame) -> DataFrame:
    return spearman(gated.filter(is_holdout() & (F.col("confidence") > 0)), "confidence", _hit())


def adversarial_detail(gated: DataFrame) -> DataFrame:
    return gated.filter(is_adversarial()).select(
        "request_id", "kind", "status", "predicted", "expected", half_even(F.col("confidence"), 2).alias("confidence")
    )


def two_level_report(gated: DataFrame, accept_at: float = 0.95, review_at: float = 0.70) -> DataFrame:
    return (
        gated.groupBy(two_level_status(F.col("confidence"), accept_at, review_at).alias("level"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(_hit()).alias("n_right"))
        .withColumn("accuracy", half_even(ratio(F.col("n_right"), F.col("n"))))
    )


def baseline_catch(gated: DataFrame, baseline: DataFrame) -> DataFrame:
    """Share of a single-call run's holdout errors that the gate flags."""
    errors = baseline.filter(~right()).select("request_id")
    one = gated.filter(is_holdout()).join(errors, "request_id", "left_semi").agg(
        F.count(F.lit(1)).alias("baseline_wrong"), F.count_if(~_ok()).alias("flagged")
    )
    return one.withColumn("catch_rate", half_even(ratio(F.col("flagged"), F.col("baseline_wrong"))))


def _step(value: Column, thresholds) -> Column:
    """How many thresholds the value reaches; NULL reaches none."""
    return sum(F.coalesce(value >= F.lit(float(t)), F.lit(False)).cast("int") for t in thresholds)


def threshold_curve(
    df: DataFrame, value: Column, thresholds, at_or_above: dict[str, Column], below: dict[str, Column]
) -> DataFrame:
    """Per threshold, counts of flags among rows that reach it and rows that do not.

    Rows are first counted by how many thresholds they reach, so the data is read
    once for any number of thresholds and only ``len(thresholds)+1`` rows remain.
    """
    ts = sorted(thresholds)
    hist = df.groupBy(_step(value, ts).alias("_s")).agg(
        *[F.count_if(c).alias(f"u_{n}") for n, c in at_or_above.items()],
        *[F.count_if(c).alias(f"d_{n}") for n, c in below.items()],
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    one = hist.agg(
        *[
            zero(F.sum(F.when(F.col("_s") > i, F.col(f"u_{n}")))).alias(f"{n}_{i}")
            for i in range(len(ts))
            for n in at_or_above
        ],
        *[
            zero(F.sum(F.when(F.col("_s") <= i, F.col(f"d_{n}")))).alias(f"{n}_{i}")
            for i in range(len(ts))
            for n in below
        ],
    )
    return long_form(
        one,
        [],
        [
            [("threshold", F.lit(float(t)))] + [(n, F.col(f"{n}_{i}")) for n in (*at_or_above, *below)]
            for i, t in enumerate(ts)
        ],
    )


def pr_curve(results: DataFrame, hit: Column, thresholds=tuple(i / 20 for i in range(21))) -> DataFrame:
    """Pickup, precision and recall of accepting at or above each threshold."""
    curve = threshold_curve(
        results,
        F.col("confidence"),
        thresholds,
        {"accepted": F.lit(True), "accepted_right": hit},
        {"left_out": F.lit(True), "left_out_right": hit},
    )
    total = F.col("accepted") + F.col("left_out")
    all_right = F.col("accepted_right") + F.col("left_out_right")
    return curve.select(
        "threshold",
        "accepted",
        "accepted_right",
        half_even(ratio(F.col("accepted"), total)).alias("pickup"),
        half_even(ratio(F.col("accepted_right"), F.col("accepted"))).alias("precision"),
        half_even(ratio(F.col("accepted_right"), all_right)).alias("recall"),
    )


def reliability_bins(results: DataFrame, hit: Column, bins: int = 10) -> DataFrame:
    """Confidence bins with their mean confidence and accuracy."""
    conf = F.col("confidence")
    b = F.least(F.floor(conf * bins), F.lit(bins - 1)).cast("int")
    return (
        results.filter(conf.between(0.0, 1.0))
        .groupBy(b.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            half_even(F.avg(conf)).alias("mean_confidence"),
            half_even(F.avg(hit.cast("double"))).alias("accuracy"),
        )
    )
