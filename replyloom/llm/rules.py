"""Quality rules whose cutoffs come from mergeable quantile sketches.

Every text is measured once. For each (lang, source) and metric the measures go into a
histogram sketch: whole-number values keep their seven leading bits, so a bucket is
less than 1 % wide, and sketches of partitions, sources or languages merge by adding counts.
A source with fewer than ``min_rows`` texts borrows the sketch of its language, a small
language that of the whole corpus: sums of the same sketches. The cutoff of a metric
is an outer fence, q3 + ``reach`` * max(q3 - q1, ``spread``). A text is kept if no
metric lies beyond its group's fence and it passes the base rules.

Edge cases: NULL and empty texts have no words and fail the base rules; NULL lang or
source is a group of its own; repeated rows count and are judged one by one; long texts
are whole; other columns of the input are ignored; an empty table gives an empty result.
Thresholds are joined to rows under a salt, so one source with most rows spreads out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from replyloom.llm import words as W
from replyloom.llm.common import per_batch
from replyloom.session import cut_lineage

#: Metrics as parts per thousand, with the least spread that counts as a real difference.
METRICS = {"symbols": 40, "dup_lines": 60, "repeats": 60, "caps": 40, "word_size": 800}
REACH = 3
MIN_ROWS = 200
MIN_WORDS = 50
SALTS = 32
MEASURED = (
    "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, n_caps bigint"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    w = W.words(texts, W.SPACE, lower=False)
    n, doc = len(texts), w.doc

    def per_doc(flags_at: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(w.base, flags_at, side="right") - 1, minlength=n)

    code_points = np.concatenate(([0], np.cumsum(W.chars(w.buf))))
    word_chars = np.bincount(doc, code_points[w.end] - code_points[w.start], minlength=n)
    line_start, line_end = W.find(w.buf, w.base, W.LINE)
    lines = np.searchsorted(w.base, line_start, side="right") - 1
    # a line is one with a word: the first word at or after its start begins before its end
    nxt = np.searchsorted(w.start, line_start)
    has = nxt < len(w.start)
    has[has] &= w.start[nxt[has]] < line_end[has]
    line_hash, lines = W.range_hashes(w.buf, line_start[has], line_end[has]), lines[has]
    ld, _, lc = W.distinct_in_doc(lines, line_hash)
    g, at = W.grams(w, 3)
    order = np.lexsort((g, doc[at]))
    gs, ds = g[order], doc[at][order]
    same = (gs[1:] == gs[:-1]) & (ds[1:] == ds[:-1])
    twice = np.zeros(len(gs), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(w.hash), bool)
    first = at[order[twice]]
    for k in range(3):
        hit[first + k] = True
    upper, letter = (np.concatenate(([0], np.cumsum(t[w.buf]))) for t in (_UPPER, _LETTER))
    up, let = upper[w.end] - upper[w.start], letter[w.end] - letter[w.start]
    caps = (let >= 2) & (up == let)
    return {
        "n_words": w.counts(), "word_chars": word_chars.astype(np.int64), "n_symbols": per_doc(np.flatnonzero(_SYMBOL[w.buf])),
        "n_lines": np.bincount(lines, minlength=n), "n_dup_lines": np.bincount(ld, lc - 1, minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(doc[hit], minlength=n), "n_caps": np.bincount(doc[caps], minlength=n),
    }


def measure(docs: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = measures(batch.column("text"))
        names = ["doc_id", "lang", "source"]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(v.astype(np.int64)) for v in m.values()], names=[*names, *m])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    return slim.mapInArrow(per_batch(run), MEASURED)


def _per_mille(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"1000 * {part} div {whole}")).otherwise(0)


def metric_columns() -> dict[str, Column]:
    return {
        "symbols": _per_mille("n_symbols", "n_words"), "dup_lines": _per_mille("n_dup_lines", "n_lines"), "repeats": _per_mille("n_repeat_words", "n_words"),
        "caps": _per_mille("n_caps", "n_words"), "word_size": _per_mille("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """The value with all but its seven leading bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
    return value - value % step


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, metric, bucket, n. Partial sums before the shuffle carry at most one row per bucket and task."""
    cols = metric_columns()
    return measured.filter(f"n_words >= {MIN_WORDS}").select(
        "lang", "source", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(c).alias("bucket")) for m, c in cols.items()]))
    ).groupBy("lang", "source", "metric", "bucket").agg(F.count("*").alias("n"))


def quartile_fences(sketch: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Fence and rows of each metric of each group, from running counts over the buckets."""
    from pyspark.sql import Window

    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*keys, "metric").orderBy("bucket")
    run = merged.withColumn("_upto", F.sum("n").over(order)).withColumn("_all", F.sum("n").over(Window.partitionBy(*keys, "metric")))
    spread = F.create_map(*[F.lit(x) for kv in METRICS.items() for x in kv])[F.col("metric")]
    q = [F.min(F.when(4 * F.col("_upto") >= k * F.col("_all"), F.col("bucket"))) for k in (1, 3)]
    return run.groupBy(*keys, "metric").agg(F.max("_all").alias("rows"), q[0].alias("_q1"), q[1].alias("_q3")).select(
        *keys, "metric", "rows", (F.col("_q3") + reach * F.greatest(F.col("_q3") - F.col("_q1"), spread)).cast("bigint").alias("fence")
    )


def thresholds(sketch: DataFrame, reach: int = REACH, min_rows: int = MIN_ROWS) -> DataFrame:
    """lang, source and one fence column a metric."""
    fine = quartile_fences(sketch, ["lang", "source"], reach)
    lang = quartile_fences(sketch, ["lang"], reach).select(F.col("lang").alias("_l"), F.col("metric").alias("_m"), F.col("rows").alias("_ln"), F.col("fence").alias("_lf"))
    # one row a metric: len(METRICS) rows in all
    whole = quartile_fences(sketch.withColumn("_one", F.lit(1)), ["_one"], reach).select(F.col("metric").alias("_w"), F.col("fence").alias("_wf"))
    picked = (
        fine.join(lang, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("metric") == F.col("_m")))
        .join(F.broadcast(whole), F.col("metric") == F.col("_w"))
        .withColumn("fence", F.when(F.col("rows") >= min_rows, F.col("fence")).when(F.col("_ln") >= min_rows, F.col("_lf")).otherwise(F.col("_wf")))
    )
    return picked.groupBy("lang", "source").agg(*[F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"max_{m}") for m in METRICS])


def judge(docs: DataFrame, reach: int = REACH, min_rows: int = MIN_ROWS) -> DataFrame:
    """A row for each document: the measures, ``base_failed``, ``kept`` and the metrics
    beyond their fences (``beyond``)."""
    measured = cut_lineage(measure(docs), "measures")
    fences = thresholds(sketches(measured), reach, min_rows)
    salted = fences.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    rows = measured.withColumn("_at", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = rows.join(
        salted, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_at") == F.col("_salt")), "left"
    )
    beyond = F.array_compact(F.array(*[F.when(c > F.col(f"max_{m}"), F.lit(m)) for m, c in metric_columns().items()]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), beyond.alias("beyond")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("beyond") == 0))
