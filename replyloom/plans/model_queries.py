"""Queries: light models over embeddings and texts, and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyloom.domain import EMBED_MODEL, INTENTS
from replyloom.functions.numeric import half_even
from replyloom.functions.replies import with_reply
from replyloom.functions.text import normalize_reply
from replyloom.operators import gate as g, models as m
from replyloom.plans import derive as d
from replyloom.plans.gate_queries import GATE_SQL
from replyloom.plans.registry import query, with_ctes
from replyloom.session import shared_folder
from replyloom.streaming import jobs

_CLASS_OF = "CASE label % 4 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(INTENTS)) + " END"


def _vectors(spark, sf):
    return d.table(spark, sf, "embeddings").withColumn("label", F.expr(_CLASS_OF))


_bundles: dict[tuple[str, str], str] = {}


def _bundle(spark, sf):
    """The classifier of these vectors as it was saved: fitted when first asked for, loaded each time."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _bundles:
        path = shared_folder(spark, "bundle")
        m.train_classifier(_vectors(spark, sf)).save(spark, path)
        _bundles[key] = path
    return m.Classifier.load(spark, _bundles[key])


# the same fit by another solver: 200 steps of gradient descent with momentum over the 65 weights of
# each class, intercepts with a step of their own
_NAMES = sorted(INTENTS)
_SCORES = ", ".join(f"list_dot_product(w[{65 * k + 1}:{65 * k + 65}], x)" for k in range(4))
_SHARES = "list_transform(e, lambda q: q / list_sum(e))"
_MISSES = " || ".join(f"list_transform(x, lambda e: e * (p[{k + 1}] - CASE WHEN y = {k + 1} THEN 1.0 ELSE 0.0 END))" for k in range(4))
_ZEROS = "list_transform(range(260), lambda j: 0.0::double)"
_FITTED = f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, list_position([{', '.join(f"'{c}'" for c in _NAMES)}], label) AS y, list_transform(embedding, lambda e: e::double) || [1.0::double] AS x
  FROM (SELECT vec_id, embedding, {_CLASS_OF} AS label FROM embeddings)
), size AS (SELECT count(*)::double AS n FROM v
), steps AS (
  SELECT 0 AS it, {_ZEROS} AS w, {_ZEROS} AS m
  UNION ALL
  SELECT it + 1, list(w + d ORDER BY j), list(d ORDER BY j) FROM (
    SELECT it, j, w, 0.8::double * m - CASE WHEN j % 65 = 0 THEN 3.0 * g ELSE 100.0 * (g + w / (10 * n)) END AS d FROM (
      SELECT it, g.j, s.w[g.j] AS w, s.m[g.j] AS m, g.s / n AS g, n FROM steps s, size, (
        SELECT j, sum(c) AS s FROM (SELECT unnest(c) AS c, generate_subscripts(c, 1) AS j FROM (
          SELECT {_MISSES} AS c FROM (SELECT x, y, {_SHARES} AS p FROM (SELECT x, y, list_transform([{_SCORES}], lambda q: exp(q)) AS e FROM steps, v))))
        GROUP BY j) g WHERE it < 200)) GROUP BY it
), fitted AS (SELECT w FROM steps ORDER BY it DESC LIMIT 1
), scored AS (SELECT vec_id, label, y, {_SHARES} AS p FROM (SELECT v.*, list_transform([{_SCORES}], lambda q: exp(q)) AS e FROM fitted, v))
"""


@query(
    "micro_train",
    _FITTED
    + f"""SELECT '{','.join(_NAMES)}' AS classes, '{EMBED_MODEL}' AS embed_model, count(*) AS n_train,
      round_even(count(*) FILTER (list_position(p, list_max(p)) = y)::double / count(*), 6) AS train_accuracy, true AS optimal,
      round_even(avg(-ln(p[y])) + (SELECT list_sum(list_transform(w, lambda q, j: CASE WHEN j % 65 = 0 THEN 0 ELSE q * q END)) FROM fitted) / (20 * count(*)), 8) AS loss
    FROM scored""",
)
def micro_train(spark, sf):
    """The saved bundle's metadata, the penalised loss at its weights and whether its gradient vanishes."""
    c = _bundle(spark, sf)
    proof = m.optimality(c, _vectors(spark, sf))
    row = [(",".join(c.classes), c.embed_model, c.n_train, round(c.train_accuracy, 6), proof.gradient < 1e-6, round(proof.loss, 8))]
    return spark.createDataFrame(row, "classes string, embed_model string, n_train bigint, train_accuracy double, optimal boolean, loss double")


@query(
    "micro_predict",
    _FITTED
    + f"""SELECT vec_id, label, [{', '.join(f"'{c}'" for c in _NAMES)}][list_position(p, list_max(p))] AS micro_label,
      round_even(list_max(p), 4) AS max_proba, 1.0::double AS mass FROM scored""",
)
def micro_predict(spark, sf):
    """Probabilities by the saved bundle."""
    vectors = _vectors(spark, sf)
    out = _bundle(spark, sf).predict(m.with_features(vectors))
    return out.select(
        "vec_id", "label", "micro_label", half_even(F.col("max_proba"), 4).alias("max_proba"),
        F.round(F.aggregate(F.map_values("proba"), F.lit(0.0), lambda s, v: s + v), 6).alias("mass"),
    )


@query(
    "text_features",
    "SELECT doc_id, greatest(length(text) - 2, 0)::double AS n_grams FROM documents",
)
def text_features(spark, sf):
    """Hashed character 3-grams of every whole text; their counts sum to their number."""
    docs = d.table(spark, sf, "documents").select("doc_id", "text")
    # the counts that are there; all other dimensions are 0
    counts = F.unwrap_udt("features")["values"]
    return m.text_features(docs).select(
        "doc_id", F.aggregate(counts, F.lit(0.0), lambda s, v: s + v).alias("n_grams")
    )


@query(
    "centroid_classify",
    f"""WITH v AS (SELECT vec_id, {_CLASS_OF} AS label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label, i, avg(x) AS y FROM v GROUP BY 1, 2),
    s AS (SELECT v.vec_id, c.label, sum(x * y) / sqrt(sum(x * x) * sum(y * y)) AS sim FROM v JOIN c USING (i) GROUP BY 1, 2)
    SELECT vec_id, arg_max(label, sim) AS centroid_label, round_even(max(sim), 6) AS similarity FROM s GROUP BY 1""",
)
def centroid_classify(spark, sf):
    vectors = _vectors(spark, sf)
    out = m.centroid_classify(vectors, m.class_centroids(vectors))
    return out.select("vec_id", "centroid_label", "similarity")


@query(
    "knn_classify",
    f"""WITH v AS (SELECT vec_id, {_CLASS_OF} AS label, list_transform(embedding, lambda x: x::double) AS e FROM embeddings),
    s AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id
        ORDER BY round_even(list_cosine_similarity(a.e, b.e), 9) DESC, b.vec_id) AS r
      FROM v a JOIN v b ON a.vec_id <> b.vec_id),
    n AS (SELECT vec_id, label, count(*) AS votes FROM s WHERE r <= 5 GROUP BY 1, 2)
    SELECT vec_id, votes, knn_label FROM (SELECT vec_id, votes, label AS knn_label,
      row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, label) AS p FROM n) WHERE p = 1""",
)
def knn_classify(spark, sf):
    """Each vector by its five nearest others."""
    vectors = _vectors(spark, sf)
    return m.knn_classify(vectors, vectors, key="vec_id", skip_self=True)


def _polled(spark, polls, schema, run):
    """Write one poll after the other, each over many files, and let ``run(stream, root)`` take up
    what is new after each; its last result."""
    path, root = shared_folder(spark, "polls"), shared_folder(spark, "stream")
    for n, rows in enumerate(polls):
        rows.write.parquet(f"{path}/poll={n}")
        out = run(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path), root)
    return out


@query("stream_event_dedup", "SELECT event_id, event_type FROM events")
def stream_event_dedup(spark, sf):
    """Two overlapping polls: a third of the events arrive again, a fifth late."""
    events = d.table(spark, sf, "events")
    again = events.filter(F.col("event_id") % 3 == 0)
    polls = [events.filter(F.col("event_id") % 5 != 0), again.unionByName(events.filter(F.col("event_id") % 5 == 0))]
    out = _polled(spark, polls, events.schema, lambda stream, root: jobs.collect_once(stream, root=root))
    return out.select("event_id", "event_type")


def _timed_events(spark, sf):
    return d.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _by_third(df, spread, late):
    """Three polls by thirds of the time from first to last, where ``late`` (0 to 2) polls pass before
    a row arrives. ``spread``: first and last time."""
    return [df.filter(F.least(F.lit(2), F.expr(_third("ts", *spread)) + late) == n) for n in range(3)]


def _third(ts: str, first: str, last: str, d_: str = d.SPARK) -> str:
    us = "unix_micros" if d_ == d.SPARK else "epoch_us"
    whole = "div" if d_ == d.SPARK else "//"
    return f"((3 * ({us}({ts}) - {first})) {whole} ({last} - {first} + 1))"


def _spread(events):
    return tuple(str(v) for v in events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first())


_DELAYED = "CASE ({0} * 3 + {1}) % 11 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END"


@query(
    "stream_votes",
    with_ctes(
        ["replies"],
        """SELECT coalesce(c.request_id, l.request_id) AS request_id, c.request_id IS NOT NULL AS closed, predicted,
          CASE WHEN c.request_id IS NOT NULL THEN coalesce(top_n, 0) END AS vote_top_count, cast(n_votes AS int) AS n_votes, coalesce(n_late, 0) AS n_late
        FROM (SELECT request_id, n_votes, arg_max(vote, n * 10 - first_pos) AS predicted, cast(max(n) AS int) AS top_n
          FROM (SELECT request_id, count(*) AS n_votes FROM in_time WHERE asked <= last_w GROUP BY 1)
          LEFT JOIN (SELECT request_id, vote, min(call_no) AS first_pos, count(*) AS n FROM in_time WHERE vote IN """
        + "(" + ", ".join(f"'{c}'" for c in INTENTS) + ")"
        + """ GROUP BY 1, 2) USING (request_id) GROUP BY 1, 2) c
        FULL JOIN (SELECT request_id, count(*) AS n_late FROM arriving WHERE is_late GROUP BY 1) l USING (request_id)""",
        {
            **{k: GATE_SQL[k] for k in ("wide",)},
            "cast_votes": "SELECT request_id, unnest([p1, p2, p3]) AS vote, unnest([1, 2, 3]) AS call_no FROM wide",
            "timed": "SELECT event_id AS request_id, ts, epoch_ms(epoch_ms(ts)) AS asked, min(epoch_us(ts)) OVER () AS lo, max(epoch_us(ts)) OVER () AS hi FROM events",
            "polls": f"""SELECT v.*, asked, least(2, {_third('ts', 'lo', 'hi', d.DUCK)} + {_DELAYED.format('v.request_id', 'call_no')}) AS poll
              FROM cast_votes v JOIN timed USING (request_id)""",
            "clocks": "SELECT p.poll, (SELECT max(asked) - INTERVAL 1 DAY FROM polls b WHERE b.poll < p.poll) AS w, (SELECT max(asked) - INTERVAL 1 DAY FROM polls) AS last_w FROM (SELECT DISTINCT poll FROM polls) p",
            "arriving": "SELECT p.*, last_w, coalesce(asked <= w, false) AS is_late FROM polls p JOIN clocks USING (poll)",
            "in_time": "SELECT * FROM arriving WHERE NOT is_late",
        },
    ),
)
def stream_votes(spark, sf):
    """Votes of three calls in three polls, one in six of them one or two polls late: requests closed
    with the votes in time, and how many of each came too late."""
    events = _timed_events(spark, sf)
    reqs = d.requests(spark, sf)
    asked = events.select(F.col("event_id").alias("request_id"), "ts")
    read = with_reply(d.replies(reqs, "gate"), "raw", when=F.col("call_no") == 3)
    vote = F.when(F.col("call_no") == 3, F.col("label")).otherwise(normalize_reply(F.col("raw")))
    votes = read.select("request_id", "call_no", vote.alias("vote")).join(asked, "request_id")
    late = F.expr(_DELAYED.format("request_id", "call_no"))
    polls = [p.select("request_id", "call_no", "vote", F.col("ts").alias("asked")) for p in _by_third(votes, _spread(events), late)]
    out = _polled(spark, polls, polls[0].schema, lambda stream, root: jobs.assemble_votes(stream, wait="1 day", root=root))
    n_late = out.late.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_late"))
    closed = out.closed.withColumn("closed", F.lit(True))
    return closed.join(n_late, "request_id", "full").select(
        "request_id", F.coalesce("closed", F.lit(False)).alias("closed"), "predicted", "vote_top_count", "n_votes", F.coalesce("n_late", F.lit(0)).cast("bigint").alias("n_late")
    )


@query(
    "stream_accuracy",
    with_ctes(
        ["replies"],
        """SELECT kind, w AS window_start, w + INTERVAL 1 DAY AS window_end, count(*) AS n, count(*) FILTER (WHERE hit) AS n_correct,
          round_even(count(*) FILTER (WHERE hit)::double / count(*), 6) AS accuracy, count(*) FILTER (WHERE status <> 'OK') AS n_escalated,
          round_even(count(*) FILTER (WHERE status <> 'OK')::double / count(*), 6) AS escalation_rate
        FROM spans WHERE w + INTERVAL 1 DAY <= final GROUP BY 1, 2, final""",
        {
            **GATE_SQL,
            "judged": "SELECT g.*, ts, (SELECT max(ts) - INTERVAL 6 HOUR FROM events) AS final FROM gated g JOIN events ON event_id = request_id",
            "spans": """SELECT hit, status, final, 'tumbling' AS kind, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS w FROM judged UNION ALL
              SELECT hit, status, final, 'sliding', time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 6 HOUR FROM judged, range(4) r(k)""",
        },
    ),
)
def stream_accuracy(spark, sf):
    """Accuracy and escalation of the gate by day, and by day every six hours, from three polls in
    which the last hours of each third partly come one poll later."""
    events = _timed_events(spark, sf)
    lo, hi = _spread(events)
    edge = F.expr(_third("timestamp_micros(unix_micros(ts) + 18000000000)", lo, hi)) > F.expr(_third("ts", lo, hi))
    polls = _by_third(events, (lo, hi), F.when(edge & (F.col("event_id") % 4 == 0), 1).otherwise(0))

    def judged(stream):
        rows = g.gate_rows(_wide_replies(d.as_requests(stream, "ts"), "ts"), "raw1", "raw2", "raw3")
        return rows.select("ts", (F.col("predicted") == F.col("expected")).alias("correct"), (F.col("status") != "OK").alias("escalated"))

    kinds = {"tumbling": None, "sliding": "6 hours"}
    plain = lambda c: F.col(c).cast("timestamp_ntz").alias(c)

    def run(stream, root):
        rows = judged(stream)
        return [
            jobs.windowed_accuracy(rows, size="1 day", slide=slide, delay="6 hours", root=f"{root}/{k}").select(F.lit(k).alias("kind"), "*")
            for k, slide in kinds.items()
        ]

    parts = _polled(spark, polls, events.schema, run)
    both = parts[0].unionByName(parts[1])
    return both.select(*[plain(c) if c.startswith("window") else c for c in both.columns])


def _wide_replies(reqs, *more):
    """Requests with their three replies in the same row, by stateless steps only."""
    df = reqs.select("request_id", "expected", "k", "value", *more)
    for model, stage, n, acc in d.RUNS["gate"]:
        keep = df.columns
        one = df.withColumns(
            {"run_id": F.lit("gate"), "model": F.lit(model), "stage": F.lit(stage), "call_no": F.lit(n), "acc": F.lit(acc)}
        )
        df = d.settled_raw(d.apply_levels(one, d.reply_levels(d.SPARK), (*keep, "raw"))).withColumnRenamed("raw", f"raw{n}")
    return df


@query(
    "stream_gate",
    with_ctes(
        ["replies"], "SELECT request_id, status, predicted, cast(top_n AS int) AS vote_top_count FROM gated", GATE_SQL
    ),
)
def stream_gate(spark, sf):
    """The gate over arriving rows that hold their three replies."""
    schema = d.table(spark, sf, "events").schema
    reqs = d.as_requests(spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*"))
    judged = g.gate_rows(_wide_replies(reqs), "raw1", "raw2", "raw3")
    return jobs.run_available(judged.select("request_id", "status", "predicted", "vote_top_count"), "gate")


@query(
    "latest_status",
    """SELECT user_id AS job_id, arg_max(event_type, (epoch_us(ts), event_id)) AS status,
    arg_max(event_type, (epoch_us(ts), event_id)) = 'signup' AS finished FROM events GROUP BY 1""",
)
def latest_status(spark, sf):
    """Last event of each user as a job's state; ``signup`` stands for a final one."""
    ev = d.table(spark, sf, "events").select(F.col("user_id").alias("job_id"), F.struct("ts", "event_id").alias("at"), "event_type")
    out = jobs.latest_status(ev.withColumnRenamed("event_type", "status"), ts="at", terminal=("signup",))
    return out
