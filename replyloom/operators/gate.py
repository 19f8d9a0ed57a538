"""Acceptance gate: format, vote of three replies, self-reported confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.domain import ACCEPT_AT, INTENTS, REJECT_BELOW
from replyloom.functions.replies import with_reply
from replyloom.functions.settle import settle
from replyloom.functions.text import domain_code, domain_label, normalize_reply, strict_format


def votes_per_request(replies: DataFrame, classes=INTENTS) -> DataFrame:
    """One row per request out of its plain calls 1 and 2 and its JSON call 3.

    Replies are read before they are grouped, down to class codes, flags and
    numbers: the shuffle carries no text and the aggregation hashes on fixed-width
    buffers. A vote outside the domain has code 0.
    """
    is_json = F.col("call_no") == 3
    df = with_reply(replies, "raw", classes=classes, when=is_json)
    vote = F.when(is_json, F.col("label")).otherwise(normalize_reply(F.col("raw")))
    df = df.withColumn("_code", domain_code(vote, classes)).withColumn(
        "_strict", F.when(~is_json, strict_format(F.col("raw"), classes))
    )
    at = lambda n, c: F.max(F.when(F.col("call_no") == n, c))
    return df.groupBy("request_id").agg(
        *[at(n, F.col("_code")).alias(f"code{n}") for n in (1, 2, 3)],
        # both plain replies must be there and well formed
        (F.coalesce(at(1, F.col("_strict")), F.lit(False)) & F.coalesce(at(2, F.col("_strict")), F.lit(False))).alias("plain_strict"),
        at(3, F.col("confidence")).alias("confidence"),
        at(3, F.col("parse_error")).alias("parse_error"),
        F.max("latency_ms").alias("latency_ms_max"),
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("tokens_total"),
        F.count(F.lit(1)).alias("n_calls"),
    )


def winning_code(codes: list[Column]) -> tuple[Column, Column, Column]:
    """Winner (NULL without a valid vote), its votes, and how many votes are valid, of class
    codes in call order where 0 is no valid vote."""
    backing = [
        F.when(me > 0, sum((me == other).cast("int") for other in codes)).otherwise(F.lit(0))
        for me in codes
    ]
    top = F.greatest(*backing) if len(backing) > 1 else backing[0]
    # ties go to the vote that was cast first
    winner = F.when(top == 0, F.lit(0))
    for code, n in zip(codes, backing):
        winner = winner.when(n == top, code)
    return winner, top, sum((c > 0).cast("int") for c in codes)


def decide(
    df: DataFrame,
    *,
    accept_at: float = ACCEPT_AT,
    reject_below: float = REJECT_BELOW,
    classes=INTENTS,
) -> DataFrame:
    """Add predicted, vote_top_count, n_valid, format_ok, status and reason to rows
    with ``code1..3``, ``plain_strict``, ``parse_error`` and ``confidence``.

    The arms are tried in order. A NULL (not a number) confidence satisfies no
    comparison and so ends in the last arm. A two-to-one vote is UNSURE whatever
    the confidence or format says.
    """
    codes = [F.coalesce(F.col(f"code{n}"), F.lit(0)) for n in (1, 2, 3)]
    winner, top_count, n_valid = winning_code(codes)
    df = df.withColumn("vote_top_count", top_count).withColumn("n_valid", n_valid)
    top, conf = F.col("vote_top_count"), F.col("confidence")
    df = df.withColumn("predicted", domain_label(winner, classes)).withColumn(
        "format_ok",
        F.coalesce(F.col("plain_strict"), F.lit(False))
        & ~F.coalesce(F.col("parse_error"), F.lit(True))
        & (codes[2] > 0),
    )
    arms: list[tuple[Column, str, str]] = [
        (top == 0, "FAIL", "no_valid_vote"),
        ((top == 3) & (conf >= accept_at) & F.col("format_ok"), "OK", "unanimous_confident"),
        ((top == 3) & (conf >= reject_below), "UNSURE", "unanimous_not_accepted"),
        (top == 2, "UNSURE", "split_vote"),
        ((top == 1) & (F.col("n_valid") == 3), "FAIL", "all_different"),
        (conf < reject_below, "FAIL", "low_confidence"),
        (~F.col("format_ok"), "FAIL", "bad_format"),
    ]
    status, reason = F.when(arms[0][0], arms[0][1]), F.when(arms[0][0], arms[0][2])
    for cond, s, r in arms[1:]:
        status, reason = status.when(cond, F.lit(s)), reason.when(cond, F.lit(r))
    return df.withColumn("status", status.otherwise(F.lit("UNSURE"))).withColumn(
        "reason", reason.otherwise(F.lit("undecided"))
    )


def gate(requests: DataFrame, replies: DataFrame, **params) -> DataFrame:
    """Requests with the gate's decision; the votes are folded to one row per
    request before the join. A request without replies has no valid vote and fails."""
    return decide(requests.join(votes_per_request(replies), "request_id", "left"), **params)


def gate_rows(df: DataFrame, plain1: str, plain2: str, json_reply: str, classes=INTENTS, **params) -> DataFrame:
    """The gate where a row already holds its three replies: a stateless
    projection, so it works on streams too."""
    df = with_reply(df, json_reply, classes=classes)
    for n, c in ((1, plain1), (2, plain2)):
        df = df.withColumn(f"code{n}", domain_code(normalize_reply(F.col(c)), classes))
    df = df.withColumn("code3", domain_code(F.col("label"), classes)).withColumn(
        "plain_strict", strict_format(F.col(plain1), classes) & strict_format(F.col(plain2), classes)
    )
    return decide(df, classes=classes, **params)


def majority_vote(votes: DataFrame, classes=INTENTS) -> DataFrame:
    """Winner among any number of votes ``(request_id, call_no, vote)``: most votes,
    then earliest call; NULL without a valid vote. Votes fold into a count and a
    first call per class, so one hash aggregation of fixed-width values does it,
    however many votes a single request has."""
    code = F.col("_code")
    aggs = []
    for i in range(1, len(classes) + 1):
        aggs += [F.count_if(code == i).alias(f"n{i}"), F.min(F.when(code == i, F.col("call_no"))).alias(f"first{i}")]
    tally = (
        settle(votes.select("request_id", "call_no", "vote"), {"_code": domain_code(F.col("vote"), classes)})
        .groupBy("request_id")
        .agg(*aggs)
    )
    ranked = F.array(
        *[
            F.struct(F.col(f"n{i}").alias("n"), (-F.col(f"first{i}")).alias("early"), F.lit(i).alias("code"))
            for i in range(1, len(classes) + 1)
        ]
    )
    best = tally.withColumn("_best", F.array_max(ranked))
    return best.select(
        "request_id",
        F.when(F.col("_best.n") > 0, domain_label(F.col("_best.code"), classes)).alias("predicted"),
        F.col("_best.n").alias("vote_top_count"),
        sum(F.col(f"n{i}") for i in range(1, len(classes) + 1)).alias("n_valid"),
    )


def two_level_status(conf: Column, accept_at: float = 0.95, review_at: float = 0.70) -> Column:
    """Accept, review with priority, or reject, on confidence alone."""
    return (
        F.when(conf >= accept_at, F.lit("accept")).when(conf >= review_at, F.lit("review")).otherwise(F.lit("reject"))
    )
