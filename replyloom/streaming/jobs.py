"""Following job events, assembling votes and judging replies as they arrive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from replyloom.domain import INTENTS
from replyloom.functions.numeric import half_even, ratio
from replyloom.functions.text import domain_code, domain_label
from replyloom.operators.gate import winning_code
from replyloom.session import existing, shared_folder

# Job states after which nothing more is expected.
TERMINAL_STATES = ("succeeded", "failed", "cancelled")


def _per_batch(stream: DataFrame, root: str, store: Callable[[DataFrame, int], None]) -> None:
    """Process what is available; a later call with the same folder goes on from there."""
    stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What was stored, or nothing where nothing was."""
    if not existing(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _day(ts: Column) -> Column:
    return F.coalesce(F.to_date(ts).cast("string"), F.lit("none"))


def stored_ids(spark: SparkSession, rows: str, key: str, schema: T.StructType, days: list[str], buckets: list[int], slack_days: int) -> DataFrame | None:
    """Ids stored for these days, and ``slack_days`` around them, in these buckets, with their
    batch; None if there are none. Only the folders of those days and buckets are listed and read."""
    near = {"none"}
    for d in days:
        if d != "none":
            at = dt.date.fromisoformat(d)
            near |= {str(at + dt.timedelta(days=n)) for n in range(-slack_days, slack_days + 1)}
    paths = existing(spark, f"{rows}/_day={{{','.join(sorted(near))}}}/_bucket={{{','.join(map(str, sorted(buckets)))}}}")
    if not paths:
        return None
    return spark.read.schema(schema).option("basePath", rows).parquet(*paths).select(F.col(key).alias("_seen"), F.col("_batch").alias("_seen_batch"))


def collect_once(
    stream: DataFrame, key: str = "event_id", ts: str = "ts", *, root: str | None = None, buckets: int = 2, slack_days: int = 1
) -> DataFrame:
    """Each event once, however often and late polls deliver it: what is available is
    processed, and everything stored comes back. ``root``: the folder of an earlier call to go on from.

    Rows are stored by event day and hash bucket of the id. A micro-batch lists and reads the ids
    of its own days (and ``slack_days`` around them) in its own buckets and nothing else, so a poll's
    cost follows the poll, not the history; nothing is forgotten and no state grows in memory.
    ``buckets``: folders a day, more for streams with many events a day and small polls.
    A batch looks only at lower batch numbers and replaces what an earlier attempt of it wrote.

    An event is its id. Its first stored delivery stays; within one batch that with the least time.
    A redelivery whose time has moved by up to ``slack_days`` days is recognised; one that moved
    further is kept as another event. Rows without an id are one event, rows without a time are
    looked up in every batch.
    """
    spark: SparkSession = stream.sparkSession
    root = root or shared_folder(spark, "events-once")
    columns = stream.columns
    place = [T.StructField("_day", T.StringType()), T.StructField("_bucket", T.IntegerType()), T.StructField("_batch", T.LongType())]
    stored = T.StructType([*stream.schema.fields, *place])

    def store(batch: DataFrame, number: int) -> None:
        first = F.min_by(F.struct(*columns), F.coalesce(F.col(ts).cast("timestamp"), F.lit("9999-01-01").cast("timestamp")))
        fresh = batch.groupBy(F.col(key).alias("_key")).agg(first.alias("_row"))
        fresh = fresh.withColumns({"_day": _day(F.col("_row")[ts]), "_bucket": F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")})
        fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            days, parts = fresh.agg(F.collect_set("_day"), F.collect_set("_bucket")).first()
            seen = stored_ids(spark, f"{root}/rows", key, stored, days, parts, slack_days) if days else None
            rows = fresh
            if seen is not None:
                rows = fresh.join(seen.filter(F.col("_seen_batch") < number), F.col("_key").eqNullSafe(F.col("_seen")), "left_anti")
            out = rows.select("_row.*", "_day", "_bucket", F.lit(number).cast("bigint").alias("_batch")).repartition("_day", "_bucket")
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day", "_bucket", "_batch").parquet(f"{root}/rows")
        finally:
            fresh.unpersist()

    _per_batch(stream, root, store)
    return _read(spark, f"{root}/rows", stored).select(*columns)


@dataclass
class Votes:
    """``closed``: a row for each request whose time is up; ``late``: votes that came too late
    for it, or without a time."""

    closed: DataFrame
    late: DataFrame


def assemble_votes(votes: DataFrame, *, wait: str = "10 minutes", calls: int = 3, classes=INTENTS, root: str | None = None) -> Votes:
    """Put together votes (request_id, call_no, vote, asked) that arrive one by one, in any order.

    ``asked`` is the time of the request. Spark keeps each open request's votes as state, class codes
    only; when the watermark (the greatest ``asked`` so far less ``wait``) reaches a request, it is closed
    with the votes it has: most votes win, then the earliest call. A vote for a request that is
    closed by then is not dropped unseen: the same batch that ignores it stores it among the late ones,
    by the same clock, kept with each batch. So every vote is in ``closed`` (``n_votes``), in ``late``, or
    still open. A vote delivered twice counts once. Calls run from 1 to ``calls``; others do not vote.
    ``root``: the folder of an earlier call, to go on from what it had open.
    """
    spark: SparkSession = votes.sparkSession
    root = root or shared_folder(spark, "votes")
    # state and clock agree to the millisecond, which is what a watermark counts in
    timed = votes.select("request_id", "call_no", "vote", F.date_trunc("millisecond", F.col("asked").cast("timestamp")).alias("asked"))
    at = lambda n: F.max(F.when(F.col("call_no") == n, domain_code(F.col("vote"), classes)))
    state = (
        timed.filter("asked is not null").withWatermark("asked", wait).groupBy("request_id", "asked")
        .agg(*[at(n).alias(f"code{n}") for n in range(1, calls + 1)])
        .select(F.lit("closed").alias("kind"), "*")
    )
    arrived = timed.select(F.lit("late").alias("kind"), "*")
    both = state.unionByName(arrived, allowMissingColumns=True)
    clock_schema = "top timestamp, _batch bigint"

    def store(batch: DataFrame, number: int) -> None:
        # what was evicted before this batch: the watermark of the batch before it
        clock = _read(spark, f"{root}/clock", T.StructType.fromDDL(clock_schema)).filter(F.col("_batch") < number - 1)
        top = clock.agg(F.max("top") - F.expr(f"interval '{wait}'")).first()[0]
        passed = F.col("asked") <= F.greatest(F.lit(top).cast("timestamp"), F.lit("1970-01-01").cast("timestamp"))
        seen = Observation()
        out = batch.observe(seen, F.max(F.when(F.col("kind") == "late", F.col("asked"))).alias("top"))
        out = out.filter((F.col("kind") == "closed") | F.col("asked").isNull() | passed)
        out.write.mode("overwrite").partitionBy("kind").parquet(f"{root}/rows/_batch={number}")
        spark.createDataFrame([(seen.get["top"],)], "top timestamp").coalesce(1).write.mode("overwrite").parquet(f"{root}/clock/_batch={number}")

    _per_batch(both, root, store)
    stored = T.StructType([f for f in both.schema.fields if f.name != "kind"] + [T.StructField("kind", T.StringType()), T.StructField("_batch", T.LongType())])
    rows = _read(spark, f"{root}/rows", stored)
    codes = [F.coalesce(F.col(f"code{n}"), F.lit(0)) for n in range(1, calls + 1)]
    winner, top, valid = winning_code(codes)
    n_votes = sum(F.col(f"code{n}").isNotNull().cast("int") for n in range(1, calls + 1))
    closed = rows.filter("kind = 'closed'").select(
        "request_id", "asked", domain_label(winner, classes).alias("predicted"), top.alias("vote_top_count"), valid.alias("n_valid"), n_votes.alias("n_votes")
    )
    late = rows.filter("kind = 'late'").select("request_id", "call_no", "vote", "asked")
    return Votes(closed, late)


def windowed_accuracy(
    judged: DataFrame, *, size: str, slide: str | None = None, delay: str = "1 hour", ts: str = "ts",
    correct: Column | None = None, escalated: Column | None = None, root: str | None = None,
) -> DataFrame:
    """window_start, window_end, n, n_correct, accuracy, n_escalated, escalation_rate of each window of
    ``size`` (each ``slide``, if they overlap), once it is final: the watermark, ``delay`` behind the
    greatest time so far, has passed its end. Counts are kept by window, however many rows fall
    into one; rows are counted where they are read before they move. Rows later than that are left out, as are
    rows without a time. Unknown correctness counts as wrong.
    """
    correct = F.col("correct") if correct is None else correct
    escalated = F.col("escalated") if escalated is None else escalated
    span = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    counted = judged.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(span.alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(correct).alias("n_correct"), F.count_if(escalated).alias("n_escalated")
    )
    final = run_available(counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "n_correct", "n_escalated"), "accuracy", root=root)
    return final.select(
        "window_start", "window_end", "n", "n_correct", half_even(ratio(F.col("n_correct"), F.col("n"))).alias("accuracy"),
        "n_escalated", half_even(ratio(F.col("n_escalated"), F.col("n"))).alias("escalation_rate"),
    )


def run_available(stream: DataFrame, purpose: str, *, root: str | None = None) -> DataFrame:
    """Process what is there into files below the shared folder, and read it back.
    Files and the query's checkpoint survive a lost executor or driver; a later call with
    the same ``root`` goes on from there."""
    spark: SparkSession = stream.sparkSession
    root = root or shared_folder(spark, purpose)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/state")
        .option("path", f"{root}/rows")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def latest_status(
    events: DataFrame, job: str = "job_id", ts: str = "ts", status: str = "status", terminal=TERMINAL_STATES
) -> DataFrame:
    """Last known state of each job and whether it is final."""
    return (
        events.groupBy(job)
        .agg(F.max_by(status, ts).alias("status"))
        .withColumn("finished", F.col("status").isin(*terminal))
    )
