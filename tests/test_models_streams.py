"""Extraction, classifiers, scoring and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from replyloom.domain import REPLY_SCHEMA
from replyloom.operators import extract as x, gate as g, metrics, models as m, score
from replyloom.streaming import jobs

GOOD = '{"primary_intent":"search","secondary_intent":"none","target_type":"file","target_name":"Main","urgency":"low","negation":true}'


def reply(i, run, stage, raw, latency=10.0):
    return (i, run, "gpt-4o-mini", stage, 1, raw, latency, 100, 10)


def test_mono_and_multi(spark):
    mono = spark.createDataFrame([reply(1, "mono", "mono", GOOD), reply(2, "mono", "mono", "{broken")], REPLY_SCHEMA)
    got = {r.request_id: r for r in x.extract_mono(mono).collect()}
    assert tuple(got[1].predicted) == ("search", "none", "file", "Main", "low", True)
    assert tuple(got[2].predicted) == ("modify", "none", "other", None, "normal", False) and got[2].parse_errors == 1
    stages = [
        reply(1, "multi", "normalize", '{"verbs":["find"],"nouns":[],"tone":"flat","language":"en"}', 100.0),
        reply(1, "multi", "classify", '{"primary_intent":"SEARCH ","secondary_intent":"x","urgency":"high"}', 30.0),
        reply(1, "multi", "target", '{"target_type":"file","target_name":"main"}', 50.0),
        reply(1, "multi", "sentiment", '{"urgency":"low","negation":"TRUE"}', 20.0),
    ]
    multi = spark.createDataFrame(stages, REPLY_SCHEMA)
    r = x.extract_multi(multi).first()
    assert tuple(r.predicted) == ("search", "none", "file", "main", "low", True)  # a stage is trusted with its own fields
    assert (r.n_calls, r.total_latency_ms, r.wall_latency_ms) == (4, 200.0, 150.0)
    items = spark.createDataFrame([(1, "open MAIN", ("search", "none", "file", "MAIN", "low", True)), (2, "b", ("search", "none", "file", None, "low", False))],
        "request_id bigint, user string, expected struct<primary_intent:string,secondary_intent:string,target_type:string,target_name:string,urgency:string,negation:boolean>")
    a = x.score_extraction(items, x.extract_mono(mono))
    b = x.score_extraction(items, x.extract_multi(multi))
    assert {q.request_id: q.correct for q in a.collect()} == {1: True, 2: False}
    acc = {q.field: q.n_correct for q in x.field_accuracy(a).collect()}
    assert acc == {"primary_intent": 1, "secondary_intent": 2, "target_type": 1, "target_name": 2, "urgency": 1, "negation": 2, "composite": 1}
    assert {q.verdict: q.n for q in x.mode_vote(a, b).collect()} == {"review": 1}  # names differ in case
    h = x.target_hallucination(a).first()
    assert (h.named, h.invented) == (1, 0)
    text = x.stage_inputs(items, multi).first().stage_input
    assert text == 'REQUEST: open MAIN\nFEATURES: {"verbs":["find"],"nouns":[],"tone":"flat","language":"en"}'


def blobs(spark, n=120, dim=6):
    rng = np.random.default_rng(3)
    names = ["search", "understand", "describe", "modify"]
    rows = []
    for i in range(n):
        v = rng.normal(size=dim) * 0.3
        v[i % 4] += 1.5
        rows.append((i, names[i % 4], [float(q) for q in v]))
    return spark.createDataFrame(rows, "id bigint, label string, embedding array<float>")


def test_classifier_reaches_the_penalised_optimum(spark, tmp_path):
    df = blobs(spark)
    c = m.train_classifier(df, c=0.5)
    lr = c.model.stages[0]
    w, b = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    rows = df.collect()
    X = np.array([r.embedding for r in rows], float)
    y = np.array([c.classes.index(r.label) for r in rows])

    def loss(w, b):
        z = X @ w.T + b
        z -= z.max(1, keepdims=True)
        ll = z[np.arange(len(y)), y] - np.log(np.exp(z).sum(1))
        return -0.5 * ll.sum() + 0.5 * (w**2).sum()

    best = loss(w, b)
    rng = np.random.default_rng(0)
    assert all(loss(w + rng.normal(size=w.shape) * 1e-2, b + rng.normal(size=b.shape) * 1e-2) > best for _ in range(50))
    assert c.classes == tuple(sorted(c.classes)) and c.n_train == 120 and c.train_accuracy > 0.95
    c.save(spark, str(tmp_path / "bundle"))
    back = m.Classifier.load(spark, str(tmp_path / "bundle"))
    proof = m.optimality(back, df, c=0.5)
    assert proof.gradient < 1e-6 and abs(proof.loss * 0.5 * len(y) - best) < 1e-6
    early = m.train_classifier(df, c=0.5, max_iter=2)
    assert m.optimality(early, df, c=0.5).gradient > 1e-4
    assert back.classes == c.classes and back.train_accuracy == c.train_accuracy
    p = back.predict(m.with_features(df)).first()
    assert abs(sum(p.proba.values()) - 1) < 1e-9 and p.proba[p.micro_label] == p.max_proba == max(p.proba.values())


def test_centroid(spark):
    df = blobs(spark)
    out = m.centroid_classify(df, m.class_centroids(df))
    assert out.filter("label = centroid_label").count() > 110
    zero = df.limit(1).withColumn("embedding", F.array(*[F.lit(0.0)] * 6))
    assert m.centroid_classify(zero, m.class_centroids(df)).first().similarity == 0.0


def test_knn_against_brute_force(spark):
    df = blobs(spark, 90)
    got = {r.id: (r.knn_label, r.votes) for r in m.knn_classify(df, df, k=5, skip_self=True).collect()}
    rows = sorted(df.collect(), key=lambda r: r.id)
    X = np.array([r.embedding for r in rows], float)
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    sim = np.round(X @ X.T, 9)
    for i, r in enumerate(rows):
        near = sorted((j for j in range(90) if j != i), key=lambda j: (-sim[i, j], j))[:5]
        tally = {}
        for j in near:
            tally[rows[j].label] = tally.get(rows[j].label, 0) + 1
        n = max(tally.values())
        assert got[r.id] == (min(l for l, c in tally.items() if c == n), n)


def isotonic(points):
    """Fitted accuracy of each (confidence, hits, n), by pooling adjacent violators in one pass."""
    out = []
    for x, h, n in sorted(points):
        out.append([h, n, [x]])
        while len(out) > 1 and out[-2][0] * out[-1][1] >= out[-1][0] * out[-2][1]:
            h, n, xs = out.pop()
            out[-1] = [out[-1][0] + h, out[-1][1] + n, out[-1][2] + xs]
    return {x: round(h / n, 6) for h, n, xs in out for x in xs}


@pytest.mark.parametrize("shape", ["noise", "rising", "falling", "teeth"])
def test_calibration_over_many_ranges(spark, shape):
    """Pooling inside ranges of 40 values and across their bounds equals pooling in one pass."""
    rng = np.random.default_rng(7)
    n = 1000
    means = {"noise": np.linspace(0.2, 0.8, n), "rising": np.arange(n) / n, "falling": 1 - np.arange(n) / n, "teeth": (np.arange(n) % 37) / 37}[shape]
    hits = rng.binomial(20, means) if shape == "noise" else (means * 1000).astype(int)
    weight = 20 if shape == "noise" else 1000
    points = [(i / n, int(h), weight) for i, h in enumerate(hits)]
    rows = spark.createDataFrame(points, "c double, h bigint, n bigint").select(F.col("c").alias("confidence"), F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("k"), "h")
    more = spark.createDataFrame([(None, 1, 1), (float("nan"), 1, 1)], "confidence double, k bigint, h bigint")
    got = {r.confidence: r.calibrated for r in m.calibrate(rows.unionByName(more), F.col("k") <= F.col("h"), range_points=40).collect()}
    want = isotonic(points)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 2e-6 for x in want)


def test_calibration_of_a_hundred_thousand_confidences(spark):
    rows = spark.range(300_000).select(((F.col("id") * 7919) % 100_000 / 100_000).alias("confidence"), (F.rand(5) < (F.col("id") * 7919) % 100_000 / 100_000).alias("hit"))
    rows.persist()
    counts = rows.groupBy("confidence").agg(F.count_if("hit").alias("h"), F.count("*").alias("n"))
    want = isotonic([tuple(r) for r in counts.collect()])
    for size in (100_000, 9_000):
        got = {r.confidence: r.calibrated for r in m.calibrate(rows, F.col("hit"), range_points=size).collect()}
        assert len(got) == 100_000 and all(abs(got[x] - want[x]) < 2e-6 for x in want)
    rows.unpersist()


def test_calibration_of_little(spark):
    none = spark.createDataFrame([], "confidence double, hit boolean")
    assert m.calibrate(none, F.col("hit")).collect() == []
    one = spark.createDataFrame([(0.5, True), (0.5, None)], "confidence double, hit boolean")
    assert [tuple(r) for r in m.calibrate(one, F.col("hit")).collect()] == [(0.5, 2, 0.5, 0.5)]


def test_scoring(spark):
    reqs = spark.createDataFrame([(1, "find it", "search"), (2, "other", "modify"), (3, None, "modify")], "request_id bigint, user string, expected string")
    rep = score.score_requests(reqs, score.keyword_scorer({"search": "find"}, "modify"), run_id="r", model="rules", tasks=2)
    assert rep.schema.names == REPLY_SCHEMA.names
    assert metrics.accuracy(metrics.score_plain(reqs, rep)).first().accuracy == 1.0
    fixed = score.score_requests(reqs, score.constant_scorer(), run_id="r", model="none")
    assert {r.raw for r in fixed.collect()} == {"search"}


def write_batches(spark, tmp_path, batches, schema):
    path = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def test_events_once_over_several_batches(spark, tmp_path):
    schema = "event_id string, ts timestamp, message string"
    import datetime as dt

    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    polls = [[("a", at(0), "x"), ("b", at(1), "y")], [("b", at(1), "y"), ("c", at(2), "z")], [("a", at(0), "x"), ("d", at(3), "w")]]
    path = write_batches(spark, tmp_path, polls, schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = jobs.collect_once(stream)
    assert sorted(r.event_id for r in out.collect()) == ["a", "b", "c", "d"]
    assert out.columns == ["event_id", "ts", "message"]
    ended = spark.createDataFrame([("j", 1, "running"), ("j", 2, "succeeded"), ("k", 1, "queued")], "job_id string, ts int, status string")
    assert {r.job_id: (r.status, r.finished) for r in jobs.latest_status(ended).collect()} == {"j": ("succeeded", True), "k": ("queued", False)}


def test_late_first_deliveries_are_kept(spark, tmp_path):
    """Six events out of time order, hours apart, one file a batch."""
    import datetime as dt

    schema = "event_id string, ts timestamp"
    at = lambda h: dt.datetime(2024, 1, 2) + dt.timedelta(hours=h)
    polls = [[("a", at(10)), ("b", at(30))], [("c", at(50))], [("d", at(-20)), ("b", at(30))], [("e", at(60)), ("f", at(1)), ("d", at(-20))]]
    path = write_batches(spark, tmp_path, polls, schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    assert sorted(r.event_id for r in jobs.collect_once(stream).collect()) == list("abcdef")


def test_stream_equals_batch_gate(spark, tmp_path):
    schema = "request_id bigint, a string, b string, c string"
    rows = [(i, "search", "search" if i % 2 else "modify", f'{{"label":"search","confidence":0.{i}}}') for i in range(1, 10)]
    path = write_batches(spark, tmp_path, [rows[:4], rows[4:]], schema)
    cols = ["request_id", "status", "predicted"]
    stream = g.gate_rows(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), "a", "b", "c").select(*cols)
    batch = g.gate_rows(spark.read.parquet(path), "a", "b", "c").select(*cols)
    assert sorted(map(tuple, jobs.run_available(stream, "t-gate").collect())) == sorted(map(tuple, batch.collect()))


def poll(spark, tmp_path, polls, schema, run):
    """One poll after the other; ``run(stream, root)`` after each."""
    path, root = str(tmp_path / "in"), str(tmp_path / "root")
    for i, rows in enumerate(polls):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{path}/poll={i}")
        out = run(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path), root)
    return out


def day(d, h=0, m=0):
    import datetime as dt

    return dt.datetime(2024, 3, 1) + dt.timedelta(days=d, hours=h, minutes=m)


def test_moved_times_and_missing_ids(spark, tmp_path):
    schema = "event_id string, ts timestamp, message string"
    polls = [
        [("a", day(0), "first"), (None, day(0), "no id"), ("n", None, "no time"), ("a", day(0, 5), "later twin")],
        [("a", day(1), "moved a day"), ("b", day(9), "far"), (None, day(0, 1), "no id"), ("n", None, "no time")],
        [("b", day(3), "moved six days"), (None, day(1), "no id"), ("n", day(5), "time came later")],
    ]
    out = poll(spark, tmp_path, polls, schema, lambda s, root: jobs.collect_once(s, root=root))
    assert sorted((r.event_id or "", r.message) for r in out.collect()) == [("", "no id"), ("a", "first"), ("b", "far"), ("b", "moved six days"), ("n", "no time")]


def test_a_poll_reads_only_its_own_days(spark, tmp_path):
    schema = "event_id bigint, ts timestamp"
    polls = [[(d * 100 + i, day(d)) for i in range(20)] for d in range(0, 40, 4)]
    out = poll(spark, tmp_path, polls, schema, lambda s, root: jobs.collect_once(s, root=root, buckets=3))
    assert out.count() == 200
    stored = T.StructType([*out.schema.fields, T.StructField("_day", T.StringType()), T.StructField("_bucket", T.IntegerType()), T.StructField("_batch", T.LongType())])
    seen = jobs.stored_ids(spark, str(tmp_path / "root" / "rows"), "event_id", stored, ["2024-03-09", "2024-03-14"], [0, 2], 1)
    places = {tuple(p.split("=")[1] for p in f.split("/") if p.startswith(("_day", "_bucket"))) for f in seen.inputFiles()}
    assert places <= {(d, b) for d in ("2024-03-09", "2024-03-13") for b in "02"} and len(places) > 2
    assert 0 < seen.count() < 40 and jobs.stored_ids(spark, str(tmp_path / "root" / "rows"), "event_id", stored, ["2020-01-01"], [0], 1) is None


def test_votes_in_time_and_late_ones(spark, tmp_path):
    """Three polls out of order; closed requests have the majority of their votes in time."""
    schema = "request_id bigint, call_no int, vote string, asked timestamp"
    labels = ["search", "modify", "describe", "nonsense"]
    import random

    rng = random.Random(3)
    votes = [(i, c, rng.choice(labels), day(0, 0, i)) for i in range(90) for c in (1, 2, 3)]
    where = {(i, c): min(2, i // 30 + rng.choice([0, 0, 0, 1, 2])) for i, c, *_ in votes}
    polls = [[v for v in votes if where[v[:2]] == n] for n in range(3)]
    for p in polls:
        rng.shuffle(p)
    polls[1] += [(3, 9, "search", day(0, 0, 3)), (777, 1, "search", None)]
    polls[2] += polls[2][:5]
    out = poll(spark, tmp_path, polls, schema, lambda s, root: jobs.assemble_votes(s, wait="5 minutes", root=root))
    tops = [max((v[3] for p in polls[:n] for v in p if v[3]), default=day(-900)) - (day(0, 0, 5) - day(0)) for n in range(4)]
    late = [v for n, p in enumerate(polls) for v in p if v[3] is None or v[3] <= tops[n]]
    in_time = {v[:2]: v for n, p in enumerate(polls) for v in p if v[3] and v[3] > tops[n] and v[1] <= 3}
    assert sorted(map(tuple, out.late.collect()), key=repr) == sorted(late, key=repr) and len(late) > 10
    batch = g.majority_vote(spark.createDataFrame([v[:3] for v in in_time.values()], "request_id bigint, call_no int, vote string"))
    want = {r.request_id: (r.predicted, r.vote_top_count, r.n_valid) for r in batch.collect()}
    got = {r.request_id: r for r in out.closed.collect()}
    assert set(got) == {i for i, *_, at in in_time.values() if at <= tops[3]} and len(got) < len(want)
    assert all((r.predicted, r.vote_top_count, r.n_valid) == want[i] for i, r in got.items())
    assert all(r.n_votes == sum(k[0] == i for k in in_time) for i, r in got.items())
    assert min(r.n_votes for r in got.values()) < 3 and out.closed.count() == len(got)


@pytest.mark.parametrize("slide", [None, "20 minutes"])
def test_windowed_accuracy_equals_batch_windows(spark, tmp_path, slide):
    schema = "ts timestamp, correct boolean, escalated boolean"
    polls = [[(day(0, 0, 7 * i + p), None if i % 9 == 0 else i % 3 > 0, i % 4 == 0) for i in range(p * 20 - p * 2, p * 20 + 20)] for p in range(3)]
    polls[1].append((None, True, True))
    out = poll(spark, tmp_path, polls, schema, lambda s, root: jobs.windowed_accuracy(s, size="1 hour", slide=slide, delay="40 minutes", root=root))
    rows = spark.createDataFrame([r for p in polls for r in p], schema)
    span = F.window("ts", "1 hour", slide) if slide else F.window("ts", "1 hour")
    whole = rows.filter("ts is not null").groupBy(span.alias("w")).agg(F.count("*").alias("n"), F.count_if("correct").alias("c"), F.count_if("escalated").alias("e"))
    final = max(r[0] for p in polls for r in p if r[0]) - (day(0, 0, 40) - day(0))
    want = sorted((r.w.start, r.w.end, r.n, r.c, round(r.c / r.n, 6), r.e, round(r.e / r.n, 6)) for r in whole.collect() if r.w.end <= final)
    assert sorted(map(tuple, out.collect())) == want and len(want) > 4
