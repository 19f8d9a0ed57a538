"""Shapes that once gave wrong or incomplete results."""

from pyspark.sql import functions as F

from replyloom.functions.replies import is_text_field
from replyloom.operators import compare, extract, gate as g, models, route as t
from replyloom.operators.skew import lookup_counted

GATE = "request_id bigint, call_no int, raw string, latency_ms double, input_tokens bigint, output_tokens bigint"
SURE = '{"label":"search","confidence":0.9}'


def test_requests_without_replies_fail_and_stay(spark):
    reqs = spark.createDataFrame([(1, "search"), (2, "search"), (3, "search")], "request_id bigint, expected string")
    rep = spark.createDataFrame([(i, n, raw, 1.0, 1, 1) for i in (1, 2) for n, raw in ((1, "search"), (2, "search"), (3, SURE)) if (i, n) != (2, 2)], GATE)
    got = {r.request_id: r for r in g.gate(reqs, rep).collect()}
    assert (got[1].status, got[1].format_ok) == ("OK", True)
    assert not got[2].format_ok  # the second plain reply is missing
    assert (got[3].status, got[3].reason, got[3].predicted) == ("FAIL", "no_valid_vote", None)


def test_null_text_is_not_the_empty_text(spark):
    left = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "a")], "request_id bigint, user string")
    right = spark.createDataFrame([("", "z", True), (None, "n", False), ("a", "x", True)], "user string, final_label string, correct boolean")
    got = {r.request_id: r.other_label for r in compare.run_join_by_text(left, right).collect()}
    assert got == {2: "z", 3: "x", 4: "x"}
    rows = spark.createDataFrame([(i, k) for i, k in enumerate([None, "", "b", "b", "c"])], "n bigint, k string")
    facts = spark.createDataFrame([(None, 1, "null"), ("", 1, "empty"), ("b", 2, "bee")], "k string, c bigint, fact string")
    for parts in (1, 2, 10):
        found = {r.n: r.fact for r in lookup_counted(rows, facts, ["k"], "c", F.col("n"), parts).collect()}
        assert found == {0: "null", 1: "empty", 2: "bee", 3: "bee"}


def test_repeated_keys_keep_their_last_type(spark):
    cases = [('{"role":"user","role":"user","content":"123456"}', "123456", True), ('{"content":"x","content":123456}', "123456", False), ('{"content":"[core]","a":1,"a":2}', "[core]", True),
             ('{"content":[1]}', "[1]", False), ('{"content":true}', "true", False), ('{"content":"true"}', "true", True), ('{"content":{"a":1}}', '{"a":1}', False), ('{"content":"plain"}', "plain", True)]
    df = spark.createDataFrame([(i, r, x) for i, (r, x, _) in enumerate(cases)], "i int, raw string, x string")
    got = {r.i: r.ok for r in df.select("i", is_text_field(F.col("raw"), F.col("x"), "content").alias("ok")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_stage_inputs_keep_every_feature(spark):
    reqs = spark.createDataFrame([(1, "u"), (2, "v"), (3, "w")], "request_id bigint, user string")
    rep = spark.createDataFrame([(1, "normalize", ' {"verbs":["a"],"extra":7} '), (2, "normalize", "broken")], "request_id bigint, stage string, raw string")
    got = {r.request_id: r.stage_input for r in extract.stage_inputs(reqs, rep).collect()}
    assert got == {1: 'REQUEST: u\nFEATURES: {"verbs":["a"],"extra":7}', 2: "REQUEST: v\nFEATURES: {}", 3: "REQUEST: w\nFEATURES: {}"}


def test_unpriced_calls_are_reported(spark):
    reqs = spark.createDataFrame([(1, "u", "search", "holdout", "en"), (2, "v", "search", "holdout", "en")], "request_id bigint, user string, expected string, kind string, lang string")
    rep = spark.createDataFrame([(1, "cheap", "gpt-4o-mini", "json", 1, SURE, 5.0, 1000000, 0), (2, "cheap", "unheard-of", "json", 1, SURE, 5.0, 1000000, 0)],
                                "request_id bigint, run_id string, model string, stage string, call_no int, raw string, latency_ms double, input_tokens bigint, output_tokens bigint")
    s = t.run_summary(t.single_model(reqs, rep, "cheap")).first()
    assert s.n_unpriced == 1 and s.total_cost_usd == 0.15 and s.api_calls == 2


def test_every_class_is_in_the_escalation_table(spark):
    res = spark.createDataFrame([("search", "holdout", "escalated"), ("search", "holdout", "cheap"), ("x", "adv-odd", "cheap")], "expected string, kind string, route string")
    got = {(r["by"], r.value): (r.kept, r.escalated) for r in t.escalation_by_class(res).collect()}
    assert got == {("class", "search"): (1, 1), ("class", "understand"): (0, 0), ("class", "describe"): (0, 0), ("class", "modify"): (0, 0), ("kind", "adv-odd"): (1, 0)}


def test_isotonic_fit_does_not_depend_on_its_ranges(spark):
    df = spark.range(5000).select((F.col("id") / 5000).alias("confidence"), (F.col("id") % 7 < F.col("id") / 700).alias("hit"))
    fine = models.calibrate(df, F.col("hit")).orderBy("confidence").collect()
    ranged = models.calibrate(df, F.col("hit"), range_points=50).orderBy("confidence").collect()
    assert len(fine) == 5000 and fine == ranged
    assert all(a.calibrated <= b.calibrated for a, b in zip(fine, fine[1:]))


def test_centroids_are_of_known_classes(spark):
    df = spark.createDataFrame([("search", [1.0, 0.0]), ("odd", [0.0, 1.0]), (None, [5.0, 5.0])], "label string, embedding array<double>")
    assert [r.label for r in models.class_centroids(df).collect()] == ["search"]
