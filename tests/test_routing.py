"""Routing replays, summaries, comparisons and run storage."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from replyloom.domain import REPLY_SCHEMA, ROUTED_ROW
from replyloom.operators import compare, route as t
from replyloom.operators.quantiles import index_percentiles
from replyloom.session import settings
from replyloom.sources import documents, runs
from replyloom.sources.documents import array_elements

REQ = "request_id bigint, user string, expected string, kind string"
SMALL, LARGE = "gpt-4o-mini", "gpt-4o"


def call(i, run, label, conf, latency=100.0, model=None, n=1):
    model = model or (LARGE if run == "strong" else SMALL)
    raw = label if conf is None else f'{{"label":"{label}","confidence":{conf}}}'
    return (i, run, model, "json", n, raw, latency, 1000, 100)


@pytest.fixture
def data(spark):
    reqs = [
        (1, "where is it", "search", "holdout"),
        (2, "why so", "understand", "holdout"),
        (3, "what is it", "describe", "holdout"),
        (4, "fix", "modify", "holdout"),
        (5, "??", "FAIL", "adv-noise"),
    ]
    reps = [
        call(1, "cheap", "search", 0.9), call(1, "strong", "modify", 0.8, 50.0),
        call(2, "cheap", "modify", 0.5), call(2, "strong", "understand", 0.9, 50.0),  # rescued
        call(3, "cheap", "describe", 0.7), call(3, "strong", "modify", 0.6, 50.0),  # broken
        call(4, "cheap", "Other", 0.99), call(4, "strong", "{oops", None, 50.0),  # outside, then unusable
        call(5, "cheap", "search", "NaN"), call(5, "strong", "search", 0.9, 50.0),
    ]
    return spark.createDataFrame(reqs, REQ), spark.createDataFrame(reps, REPLY_SCHEMA)


def by_id(df):
    return {x.request_id: x for x in df.collect()}


def test_router(data):
    got = by_id(t.route_replay(*data))
    assert {i: x.route for i, x in got.items()} == {1: "cheap", 2: "escalated", 3: "escalated", 4: "escalated", 5: "escalated"}
    assert got[2].final_label == "understand" and got[2].cheap_label == "modify" and got[2].correct
    assert got[4].final_label == "" and not got[4].correct  # the strong answer stands, valid or not
    assert got[1].total_latency_ms == 100.0 and got[2].total_latency_ms == 150.0
    assert abs(got[1].total_cost - 0.00021) < 1e-12 and abs(got[2].total_cost - (0.00021 + 0.0035)) < 1e-12
    assert [c.model for c in got[2].calls] == [SMALL, LARGE] and got[1].n_calls == 1


def test_extreme_thresholds_are_the_single_models(data):
    same = lambda a, b: {i: (x.final_label, x.correct) for i, x in by_id(a).items()} == {i: (x.final_label, x.correct) for i, x in by_id(b).items()}
    valid = data[0].filter("request_id < 4"), data[1]
    assert same(t.route_replay(*valid, below=0.0), t.single_model(*valid, "cheap"))
    assert same(t.route_replay(*valid, below=1.1), t.single_model(*valid, "strong"))


def test_modes_in_one_join_agree(data):
    fused = t.replay_modes(*data)
    keep = ["request_id", "route", "final_label", "n_calls", "total_latency_ms", "correct"]
    rows = lambda df: sorted(tuple(str(v) for v in x) for x in df.select(*keep).collect())
    for run, other in (("router", t.route_replay(*data)), ("cheap", t.single_model(*data, "cheap")), ("strong", t.single_model(*data, "strong"))):
        assert rows(fused.filter(F.col("run_id") == run)) == rows(other)


def test_missing_fallback_and_unknown_model(spark, data):
    reqs, reps = data
    got = by_id(t.route_replay(reqs, reps.filter("run_id = 'cheap' OR request_id <> 2")))
    assert got[2].route == "escalated" and got[2].final_label is None and not got[2].correct
    odd = spark.createDataFrame([call(1, "cheap", "search", 0.9, model="m")], REPLY_SCHEMA)
    assert t.with_cost(odd).select("cost", "unknown_model").first() == (None, True)


def test_requests_without_replies_are_rows(spark, data):
    reqs, reps = data
    some = reps.filter("NOT (request_id = 1 AND run_id = 'cheap') AND request_id <> 4 AND NOT (request_id = 3 AND run_id = 'strong')")
    got = by_id(t.route_replay(reqs, some))
    assert set(got) == {1, 2, 3, 4, 5}
    assert (got[1].route, got[1].final_label, got[1].n_calls, got[1].n_missing, got[1].total_latency_ms) == ("escalated", "modify", 1, 1, 50.0)
    assert (got[3].final_label, got[3].n_calls, got[3].n_missing, got[3].total_latency_ms) == (None, 1, 1, 100.0)
    assert (got[4].final_label, got[4].n_calls, got[4].n_missing, got[4].total_cost, got[4].total_latency_ms, got[4].calls) == (None, 0, 2, None, None, [])
    alone = by_id(t.single_model(reqs, some, "strong"))
    assert len(alone) == 5 and alone[3].route is None and not alone[3].correct and alone[3].n_missing == 1
    modes = t.replay_modes(reqs, some)
    assert {r.run_id: (r.total, r.n_missing, r.api_calls) for r in t.run_summary(modes).collect()} == {"cheap": (5, 2, 3), "strong": (5, 2, 3), "router": (5, 4, 6)}
    none = t.run_summary(t.single_model(reqs, reps.limit(0), "strong"), []).first()
    assert (none.total, none.correct_total, none.n_missing, none.latency_p95_ms, none.total_cost_usd) == (5, 0, 5, None, None)
    tiers = by_id(t.three_tier(reqs, some))
    assert len(tiers) == 5 and tiers[2].final_label == "understand" and tiers[2].n_missing == 1
    assert len(by_id(t.best_of_two(reqs, some))) == len(by_id(t.reply_doubt(reqs, some))) == 5


def test_all_runs_are_dealt_out_once(data):
    """Requests and replies move once each, however many runs a route reads."""
    reqs, reps = data
    one = t.three_tier(reqs, reps).drop("calls")
    spark = reqs.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Join") == 1


def test_latest_call_wins(spark):
    rows = [call(1, "cheap", "search", 0.9) + (1,), call(1, "cheap", "modify", 0.9) + (2,)]
    schema = T.StructType(REPLY_SCHEMA.fields + [T.StructField("pos", T.IntegerType())])
    df = spark.createDataFrame(rows, schema)
    assert "modify" in t.latest_calls(df, "pos").first().raw


def test_variants(spark, data):
    best = by_id(t.best_of_two(*data))
    assert best[3].final_label == "describe" and best[2].final_label == "understand"
    lim = t.class_thresholds(F.col("cheap__label"), {"describe": 0.6})
    assert by_id(t.route_replay(*data, below=lim))[3].route == "cheap"
    reqs, reps = data
    extra = spark.createDataFrame([call(i, "mid", "describe", 0.9 if i == 3 else 0.1) for i in range(1, 6)] + [call(i, "cheap2", "search", 0.9) for i in range(1, 6)], REPLY_SCHEMA)
    tiers = by_id(t.three_tier(reqs, reps.unionByName(extra)))
    assert {i: x.route for i, x in tiers.items()} == {1: "cheap", 2: "strong", 3: "mid", 4: "strong", 5: "strong"}
    assert tiers[3].n_calls == 2 and tiers[2].n_calls == 3
    doubt = by_id(t.reply_doubt(reqs, reps.unionByName(extra)))
    assert doubt[1].route == "cheap" and doubt[2].route == "escalated" and doubt[1].n_calls == 2


def test_summary_headline_saving(data):
    s = t.run_summary(t.replay_modes(*data))
    rows = {x.run_id: x for x in s.collect()}
    r = rows["router"]
    assert (r.total, r.holdout_total, r.adv_total, r.correct_total, r.escalated, r.api_calls) == (5, 4, 1, 2, 4, 9)
    assert (r.latency_p50_ms, r.latency_p95_ms, r.total_cost_usd) == (150, 150, round(5 * 0.00021 + 4 * 0.0035, 6))
    h = {x.run_id: x for x in t.headline(s).collect()}["cheap"]
    assert (h.holdout_correct, h.adv_correct, h.adv_total) == (2, 0, 1)
    save = {x.base_run: x for x in t.cost_saving(s, "router", ("cheap", "strong")).collect()}
    assert save["strong"].saving == round((0.0175 - 0.01505) / 0.0175, 6)


def test_summary_does_not_depend_on_layout(data):
    reqs, reps = data
    a = t.run_summary(t.replay_modes(reqs.repartition(1), reps.repartition(1))).orderBy("run_id").collect()
    b = t.run_summary(t.replay_modes(reqs.repartition(5), reps.repartition(3))).orderBy("run_id").collect()
    assert a == b


def test_compare(data):
    router, cheap = t.route_replay(*data), t.single_model(*data, "cheap")
    got = {x.request_id: x.outcome for x in compare.rescued_broken(router, cheap).collect()}
    assert got == {2: "rescued", 3: "broken"}
    strong = t.single_model(*data, "strong").filter("request_id <> 5")
    a = compare.run_agreement(router, strong).first()
    assert (a.total, a.same, a.agreement) == (5, 3, 0.6)
    m = {x.outcome: x.n for x in compare.outcome_matrix(router, strong).collect()}
    assert m["unmatched"] == 1 and sum(m.values()) == 5
    ex = compare.outcome_examples(router, cheap, 1).collect()
    assert len(ex) == len({x.outcome for x in ex}) == 4
    assert compare.run_stability(router, router).first().stable


def test_repeated_text_keeps_the_last_row(spark):
    rows = [(1, "same", "search", True), (2, "same", "modify", False), (3, "other", "search", True)]
    df = spark.createDataFrame(rows, "request_id bigint, user string, final_label string, correct boolean")
    last = compare.last_per_text(df, "request_id")
    got = {x.request_id: x.other_label for x in compare.run_join_by_text(df, last).collect()}
    assert got == {1: "modify", 2: "modify", 3: "search"}


def test_percentiles_of_wide_groups(spark):
    """Values of many sizes, signs and repeats, one of 10**12; every index of every group."""
    import random

    rng = random.Random(2)
    data = {g: [float(rng.choice([rng.randint(-9000, 9000), rng.randint(0, 10**rng.randint(1, 11))])) for _ in range(rng.randint(1, 300))] for g in "abcd"}
    data["a"] += [1e12, -1e12, 5e11]
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), (None, 7.0), ("empty", None)]
    quantiles = [(f"q{i}", i / 20) for i in range(20)]
    got = index_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], F.col("v"), quantiles).collect()
    by = {r.g: r for r in got}
    for g, vs in data.items():
        assert [by[g][name] for name, _ in quantiles] == [int(sorted(vs)[int(len(vs) * q)]) for _, q in quantiles]
    assert by["a"].n == len(data["a"]) + 1 and by[None].q10 == 7 and by["empty"].q10 is None


@pytest.mark.parametrize("n", [1, 2, 4, 20, 50])
def test_index_percentiles(spark, n):
    values = [float((i * 37) % n) + 0.4 for i in range(n)]
    got = index_percentiles(spark.createDataFrame([(v,) for v in values], "v double"), [], F.col("v")).first()
    s = sorted(values)
    assert (got.n, got.latency_p50_ms, got.latency_p95_ms) == (n, round(s[n // 2]), round(s[int(n * 0.95)]))


def test_percentiles_of_nothing(spark):
    got = index_percentiles(spark.createDataFrame([], "v double"), [], F.col("v")).first()
    assert got.latency_p50_ms is None


def test_micro_route_and_reports(spark, data):
    reqs, reps = data
    micro = spark.createDataFrame(
        [(1, "search", 0.6, 10, 5.0), (2, "understand", 0.59, 10, 5.0), (3, "modify", 0.9, 10, 5.0), (4, "modify", 0.3, 10, 5.0), (5, "search", 0.97, 10, 5.0)],
        "request_id bigint, micro_label string, max_proba double, embed_tokens bigint, embed_latency_ms double",
    )
    res = t.micro_route(reqs, micro, reps)
    got = by_id(res)
    assert {i: x.route for i, x in got.items()} == {1: "stayed", 2: "escalated", 3: "stayed", 4: "escalated", 5: "stayed"}
    assert got[4].final_label is None and got[2].final_label == "modify"
    assert abs(got[1].total_cost - 2e-7) < 1e-15 and got[2].total_latency_ms == 105.0
    reg = t.escalation_regret(res).first()
    assert (reg.needless, reg.lost) == (2, 2)
    sweep = {x.threshold: x for x in t.threshold_sweep(res, (0.5, 0.95)).collect()}
    assert (sweep[0.5].stay, sweep[0.5].n_correct, sweep[0.5].unknown) == (4, 2, 0)
    assert (sweep[0.95].stay, sweep[0.95].unknown) == (1, 2)  # 1 and 3 stayed, so no fallback is known
    assert sorted(x.request_id for x in t.active_learning(res).collect()) == [3, 5]
    noisy = t.micro_route(reqs, micro, reps, noisy=t.noisy_input(F.col("user"), F.col("max_proba"), 3))
    assert by_id(noisy)[5].route == "escalated"


def test_run_documents_and_tables(spark, tmp_path, data):
    res = t.route_replay(*data)
    doc = {"mode": "router", "results": [json.loads(x) for x in res.select(F.to_json(F.struct(*[f.name for f in ROUTED_ROW]))).toPandas().iloc[:, 0]]}
    path = tmp_path / "run.json"
    path.write_text(json.dumps(doc))
    back = runs.read_run_document(spark, str(path))
    assert back.count() == 5 and {x.position for x in back.collect()} == set(range(5))
    assert runs.explode_calls(res).count() == 9
    store = str(tmp_path / "runs")
    runs.write_run(t.replay_modes(*data), store)
    runs.write_run(res, store)  # replaces only its own run
    assert runs.read_runs(spark, store).count() == 15
    plan = runs.read_runs(spark, store, "cheap")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan or "PartitionFilters: [(run_id" in plan
    runs.write_summary(t.run_summary(res), {"threshold": 0.85}, str(tmp_path / "summary"))
    assert spark.read.parquet(str(tmp_path / "summary")).first().config_threshold == 0.85
    assert runs.baseline_metrics(spark, str(tmp_path / "absent.json")).count() == 0
    base = {"model": "m", "metrics": {}, "results": [{"user": "a", "expected": "search", "correct": True}, {"user": "b", "expected": "search", "correct": False}]}
    (tmp_path / "base.json").write_text(json.dumps(base))
    assert runs.baseline_metrics(spark, str(tmp_path / "base.json")).first().accuracy == 0.5


@pytest.mark.parametrize("size, indent", [(331, None), (1009, 2), (1000000, None)])
def test_one_document_over_many_blocks(spark, tmp_path, size, indent):
    """Wherever blocks begin: inside strings with braces and escapes, between elements, in other arrays."""
    nasty = ['a}b', 'quote \\" } ] , {', 'back\\\\', '', '}}}}', 'é✓}', '[1,2]', '\n}\t', '\\']
    results = [{"user": nasty[i % len(nasty)], "n": i, "more": {"list": [1, [2, {"x": "}"}]], "s": nasty[(i + 1) % len(nasty)]}} for i in range(40)]
    doc = {"config": {"results": ["no", "}"], "t": [0]}, "mode": "router", "empty": [], "results": results, "after": [{"user": "not this"}], "z": "}"}
    path = tmp_path / "docs"
    path.mkdir()
    (path / "a.json").write_text(json.dumps(doc, indent=indent) + ("\n" if indent else ""), encoding="utf-8")
    (path / "b.json").write_text(json.dumps({"model": "m", "results": [], "x": 1}))
    (path / "c.json").write_text(json.dumps({"results": results[:1]}, ensure_ascii=False), encoding="utf-8")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}):
        elements, fields = array_elements(spark, str(path))
        got = elements.collect()
        named = {(r.file.rsplit("/", 1)[1], r.key): r.value for r in fields.collect()}
    by = {}
    for r in got:
        by.setdefault(r.file.rsplit("/", 1)[1], {})[r.position] = json.loads(r.text)
    assert [by["a.json"][i] for i in range(40)] == results and len(by["a.json"]) == 40
    assert by["c.json"] == {0: results[0]} and set(by) == {"a.json", "c.json"}
    assert named[("a.json", "mode")] == "router" and named[("b.json", "model")] == "m"


def test_document_blocks_are_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text(json.dumps({"mode": "router", "results": [{"user": f"u{i}", "expected": "search"} for i in range(2000)]}))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}):
        lines = spark.read.option("lineSep", "}").text(str(path))
        assert lines.select(F.spark_partition_id().alias("p")).distinct().count() > 5
        back = runs.read_run_document(spark, str(path))
        assert sorted((r.position, r.user) for r in back.collect()) == [(i, f"u{i}") for i in range(2000)]
        assert {r.run_id for r in back.collect()} == {"router"}


def test_documents_cut_after_any_braces():
    """Blocks begin after a brace, which may be inside a string, at any depth or in another array."""
    import random

    rng = random.Random(0)
    nasty = ['a}b', 'quote \\" } ] , {', 'back\\\\', '', '}}}}', 'é✓}', '[1,2]', '\n}\t', '\\']
    results = [{"user": nasty[i % len(nasty)], "n": i, "more": {"list": [1, [2, {"x": "}"}]], "s": nasty[(i + 1) % len(nasty)]}} for i in range(12)]
    doc = {"config": {"results": ["no", "}"], "t": [0]}, "empty": [], "results": results, "after": [{"user": "not this"}], "z": "}"}
    for _ in range(500):
        text = json.dumps(doc, indent=rng.choice([None, 2])) + rng.choice(["", "\n"])
        braces = [i + 1 for i, c in enumerate(text) if c == "}" and i + 1 < len(text)]
        at = [0, *sorted(rng.sample(braces, rng.randint(0, len(braces)))), len(text)]
        state, inside, before, parts = (False, 0), False, 0, {}
        for a, b in zip(at, at[1:]):
            in_string, deeper = documents._ends(text[a:b], state[0])
            *got, end = documents._cut(text[a:b], *state, "results")
            closed = lambda fresh: sum(kind == "part" and shut and f == fresh for kind, f, _, shut, _, _ in got)
            new = before + (closed(False) if inside else 0)
            for kind, fresh, n, _, _, part in got:
                if kind == "part" and (fresh or inside):
                    parts.setdefault(n + (new if fresh else before), []).append(part)
            before, inside = new + closed(True), end[3] and (end[1] or inside)
            state = (in_string, state[1] + deeper)
        assert [json.loads("".join(parts[i])) for i in sorted(parts)] == results
