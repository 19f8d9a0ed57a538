"""The gate's truth table, votes and reports."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyloom.operators import gate as g, gate_report as r
from replyloom.operators.common import right

SCHEMA = "request_id bigint, call_no int, raw string, latency_ms double, input_tokens bigint, output_tokens bigint"


def replies(*triples):
    return [(i, n, raw, float(n), 1, 1) for i, t in enumerate(triples) for n, raw in enumerate(t, start=1)]


def js(label, conf):
    return f'{{"label":"{label}","confidence":{conf}}}'


TABLE = [
    (("x", "y", js("z", 0.9)), "FAIL", None, 0),
    (("search", "search", js("search", 0.85)), "OK", "search", 3),
    (("search", "search", js("search", 0.84)), "UNSURE", "search", 3),
    (("Search.", "search", js("search", 0.99)), "UNSURE", "search", 3),  # bad format
    (("search", "modify", js("search", 0.4)), "UNSURE", "search", 2),  # split, whatever the confidence
    (("search", "modify", js("describe", 0.99)), "FAIL", "search", 1),  # all differ, first vote named
    (("search", "search", js("search", 0.49)), "FAIL", "search", 3),
    (("x", "modify", js("other", 0.9)), "FAIL", "modify", 1),  # one valid vote
    (("modify", "describe", "{bad"), "FAIL", "modify", 1),
    (("search", "search", js("search", "NaN")), "UNSURE", "search", 3),  # no number: last arm
]


def test_truth_table(spark):
    df = spark.createDataFrame(replies(*[t for t, *_ in TABLE]), SCHEMA)
    got = {x.request_id: x for x in g.decide(g.votes_per_request(df)).collect()}
    for i, (_, status, predicted, top) in enumerate(TABLE):
        assert (got[i].status, got[i].predicted, got[i].vote_top_count) == (status, predicted, top), TABLE[i]
    assert got[9].reason == "undecided"


def test_row_form_agrees(spark):
    trips = [(a, b, js(c, q)) for a, b, c in itertools.product(("search", "modify", "Search.", "x"), repeat=3) for q in (0.2, 0.6, 0.9)]
    long = g.decide(g.votes_per_request(spark.createDataFrame(replies(*trips), SCHEMA)))
    wide = spark.createDataFrame([(i, *t) for i, t in enumerate(trips)], "request_id bigint, a string, b string, c string")
    rows = g.gate_rows(wide, "a", "b", "c")
    pick = lambda df: sorted((x.request_id, x.status, x.predicted or "", x.vote_top_count) for x in df.collect())
    assert pick(long) == pick(rows)
    statuses = [x[1] for x in pick(rows)]
    assert set(statuses) <= {"OK", "UNSURE", "FAIL"} and len(statuses) == len(trips)


def test_thresholds_are_parameters(spark):
    df = g.votes_per_request(spark.createDataFrame(replies(("search", "search", js("search", 0.6))), SCHEMA))
    assert g.decide(df, accept_at=0.5).first().status == "OK"


def test_majority_vote_ties_go_to_the_first_call(spark):
    rows = [(1, 3, "search"), (1, 1, "modify"), (1, 2, "search"), (1, 4, "modify"), (2, 1, "zzz"), (2, 2, "describe"), (3, 1, "zzz")]
    got = {x.request_id: (x.predicted, x.vote_top_count, x.n_valid) for x in g.majority_vote(spark.createDataFrame(rows, "request_id bigint, call_no int, vote string")).collect()}
    assert got == {1: ("modify", 2, 4), 2: ("describe", 1, 1), 3: (None, 0, 0)}


GATED = "request_id bigint, kind string, expected string, predicted string, status string, confidence double, code1 int, code2 int, code3 int, format_ok boolean"


def gated(spark, rows):
    return spark.createDataFrame(rows, GATED)


def test_reports_on_empty_input(spark):
    none = gated(spark, [])
    q = r.gate_quality(none).first()
    assert (q.holdout_total, q.pickup_rate, q.catch_rate) == (0, 0.0, 0.0)
    assert r.confidence_spearman(none).first().rho == 0.0
    assert r.confidence_gap(none).first().gap == 0.0
    assert r.class_status(none).count() == 4
    assert r.status_breakdown(none).count() == 9
    assert [x.accepted for x in r.pr_curve(none, right("predicted"), (0.5,)).collect()] == [0]


def test_quality_and_signals(spark):
    rows = [
        (1, "holdout", "search", "search", "OK", 0.9, 1, 1, 1, True),
        (2, "holdout", "search", "modify", "UNSURE", 0.9, 4, 4, 1, True),  # split, json dissents
        (3, "holdout", "search", None, "FAIL", 0.2, 0, 0, 0, False),
        (4, "holdout", "modify", "search", "OK", 0.95, 1, 1, 1, True),  # accepted and wrong
        (5, "adv-x", "FAIL", "search", "OK", 0.9, 1, 1, 1, True),
        (6, "adv-x", "FAIL", "search", "UNSURE", 0.6, 1, 1, 1, True),
    ]
    q = r.gate_quality(gated(spark, rows)).first()
    assert (q.holdout_accepted, q.holdout_accepted_right, q.holdout_wrong, q.holdout_caught) == (2, 1, 3, 2)
    assert (q.pickup_rate, q.rejection_rate, q.catch_rate) == (0.5, 0.5, 0.666667)
    s = {x.signal: x.n for x in r.signal_isolation(gated(spark, rows)).collect()}
    assert s == {"format": 1, "vote_split": 1, "low_confidence": 1, "vote_vs_json": 1}


def _ranks(v):
    v = np.asarray(v, float)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


@pytest.mark.parametrize("steps", [2, 7, 256])
def test_spearman_against_definition(spark, steps):
    rng = random.Random(steps)
    rows = [(rng.choice([rng.random(), 0.5, 0.9]), rng.random() < 0.6) for _ in range(400)]
    rows += [(0.5, True)] * 200  # a hot value
    want = np.corrcoef(_ranks([a for a, _ in rows]), _ranks([b for _, b in rows]))[0, 1]
    got = r.spearman(spark.createDataFrame(rows, "v double, h boolean").repartition(5), "v", F.col("h"), steps).first()
    assert got.n == 600 and abs(got.rho - want) < 1e-5


@pytest.mark.parametrize("rows", [[(0.5, True)], [(0.5, True), (0.5, False)], [(0.1, True), (0.9, True)]])
def test_spearman_degenerate(spark, rows):
    assert r.spearman(spark.createDataFrame(rows, "v double, h boolean"), "v", F.col("h")).first().rho == 0.0


def test_threshold_curve_counts_nulls_below(spark):
    df = spark.createDataFrame([(0.2,), (0.5,), (None,), (0.9,)], "p double")
    rows = r.threshold_curve(df, F.col("p"), (0.9, 0.5), {"up": F.lit(True)}, {"down": F.lit(True)}).collect()
    assert [tuple(x) for x in rows] == [(0.5, 2, 2), (0.9, 1, 3)]


def test_baseline_missing_document(spark):
    rows = [(1, "holdout", "search", "search", "OK", 0.9, 1, 1, 1, True)]
    out = r.gated_vs_baseline(gated(spark, rows), spark.createDataFrame([], "accuracy double")).first()
    assert out.baseline_accuracy is None and out.gated_accuracy == 1.0 and out.flagged == 0
