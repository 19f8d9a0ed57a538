"""Ordinal quality classifier: cumulative-link regression on hashed text features.

A grade is 0..K-1. One weight vector w is shared by all grades; ordered thresholds
t_1 < ... < t_{K-1} cut the line: P(grade >= k) = sigmoid(w.x - t_k). The expected grade
is the sum of these tails. Features are hashed words, word shapes and repetitions
of a text, so a text needs no dictionary and no second pass.

Edge cases: a NULL or empty text has the bias feature alone and gets a score like any
other; very long texts are processed in slices of words with bounded arrays; repeated
rows are scored each; ids and labels may be NULL (rows without a label do not take part
in the fit); further columns of the input are ignored (``score``) or passed through
(``select``); an empty table gives an empty result; without any labels every document
has the neutral tail 0.5 and is kept.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from replyloom.llm import words as W
from replyloom.llm.common import per_batch, two_columns

DIMS = 1 << 14
#: Bound on labelled rows that the fit uses; the rows with the smallest id hash are taken.
SAMPLE_ROWS = 12_000
FIT_STEPS = 150
RIDGE = 2e-4
KEEP_TAIL = 0.5
_SHAPE = np.zeros(256, np.uint64)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 1, 2, 3, 1
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _SHAPE[_c] = 4


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, dimension, value) triples: three groups (words, shapes, repetition), each
    scaled to length one, and a bias in dimension 0."""
    w = W.words(texts, W.SPACE, lower=True)
    raw, _ = W.text_bytes(texts)
    n = len(texts)
    rows, dims, vals = [np.arange(n)], [np.zeros(n, np.int64)], [np.ones(n)]

    def group(doc, code, salt, scale):
        with np.errstate(over="ignore"):
            dim = 1 + (W.mix(code.astype(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(DIMS - 1)).astype(np.int64)
        d, v, c = W.distinct_in_doc(doc, dim)
        x = np.log1p(c.astype(float))
        norm = np.sqrt(np.bincount(d, x * x, minlength=n))
        rows.append(d), dims.append(v), vals.append(scale * x / norm[d])

    if len(w.hash):
        group(w.doc, w.hash, 1, 0.5)
        # shape: kinds of the first and last three bytes
        code = np.zeros(len(w.hash), np.uint64)
        for i in range(3):
            code = code * np.uint64(8) + _SHAPE[raw[np.minimum(w.start + i, w.end - 1)]]
            code = code * np.uint64(8) + _SHAPE[raw[np.maximum(w.end - 1 - i, w.start)]]
        total = w.counts().astype(float)
        d, v, c = W.distinct_in_doc(w.doc, code)
        with np.errstate(over="ignore"):
            dim = 1 + (W.mix(v + np.uint64(77)) % np.uint64(DIMS - 1)).astype(np.int64)
        rows.append(d), dims.append(dim), vals.append(2.0 * c / total[d])
        # share of three-word runs seen before, in tenths, and length in powers of two
        g, at = W.grams(w, 3)
        gd, _, gc = W.distinct_in_doc(w.doc[at], g)
        again = np.bincount(gd, gc - 1, minlength=n) / np.maximum(total - 2, 1)
        have = np.flatnonzero(total > 0)
        tenth = np.minimum((again[have] * 10).astype(np.int64), 9)
        size = np.log2(total[have]).astype(np.int64)
        for salt, code in ((3, tenth), (4, size)):
            group(have, code, salt, 1.0)
    return np.concatenate(rows), np.concatenate(dims), np.concatenate(vals)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, a row per text."""
        r, d, v = features(texts)
        z = np.bincount(r, v * self.weights[d], minlength=len(texts))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -50, 50)))


def fit_arrays(rows, dims, vals, grades: np.ndarray, levels: int, steps: int = FIT_STEPS) -> Model:
    """Accelerated gradient descent on the cumulative-link likelihood; thresholds are a first
    one plus softplus gaps, which keeps them in order."""
    n = len(grades)
    theta_w, theta_t = np.zeros(DIMS), np.full(levels - 1, 0.5)
    share = np.clip([np.mean(grades >= k) for k in range(1, levels)], 0.01, 0.99)
    theta_t[0] = -np.log(share[0] / (1 - share[0]))
    m, v = np.zeros(DIMS + levels - 1), np.zeros(DIMS + levels - 1)
    for step in range(1, steps + 1):
        gaps = np.log1p(np.exp(theta_t[1:]))
        t = theta_t[0] + np.concatenate(([0], np.cumsum(gaps)))
        z = np.bincount(rows, vals * theta_w[dims], minlength=n)
        upper = np.concatenate((np.ones((n, 1)), 1 / (1 + np.exp(np.clip(t[None, :] - z[:, None], -50, 50))), np.zeros((n, 1))), axis=1)
        slope = upper * (1 - upper)
        i = np.arange(n)
        p = np.maximum(upper[i, grades] - upper[i, grades + 1], 1e-9)
        gz = -(slope[i, grades] - slope[i, grades + 1]) / p / n
        gt = np.zeros(levels + 1)
        np.add.at(gt, grades, slope[i, grades] / p / n)
        np.add.at(gt, grades + 1, -slope[i, grades + 1] / p / n)
        gt = gt[1:levels]
        g_first = gt.sum()
        g_gaps = np.array([gt[k:].sum() for k in range(1, levels - 1)]) / (1 + np.exp(-theta_t[1:]))
        gw = np.bincount(dims, vals * gz[rows], minlength=DIMS) + RIDGE * theta_w
        g = np.concatenate((gw, [g_first], g_gaps))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * min(1.0, 2 * (1 - step / (steps + 1)))
        theta_w -= move[:DIMS]
        theta_t -= move[DIMS:]
    gaps = np.log1p(np.exp(theta_t[1:]))
    return Model(theta_w, theta_t[0] + np.concatenate(([0], np.cumsum(gaps))))


def graded(labels: DataFrame) -> DataFrame:
    """Grade of a labelled document: 0 poor, 1 fair but toxic, 2 good."""
    return labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min(F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)).alias("grade")
    )


def fit(docs: DataFrame, ratings: DataFrame, levels: int = 3, sample_rows: int = SAMPLE_ROWS, fold: int = 5) -> Model | None:
    """``ratings``: doc_id, grade. Rows whose crc32(doc_id) mod ``fold`` is 0 are held out.
    At most ``sample_rows`` rows take part, as sparse rows of at most ``DIMS`` values each. One
    task holds them and fits; the driver gets the weights."""
    chosen = (
        ratings.filter(F.crc32(F.col("doc_id").cast("string")) % fold != 0)
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    rated = two_columns(docs).join(F.broadcast(chosen), "doc_id")

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        r, d, v = features(batch.column("text"))
        order = np.argsort(r, kind="stable")
        at = np.searchsorted(r[order], np.arange(batch.num_rows + 1))
        lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x)) for x in (d[order].astype(np.int32), v[order].astype(np.float32))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), *lists], names=["doc_id", "grade", "d", "v"])

    def fitted(got: pa.Table) -> pa.Table:
        # one row an id, whatever order they come in
        got = got.sort_by([("doc_id", "ascending")])
        ids = got.column("doc_id").to_numpy()
        got = got.take(np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))))
        d, v = (got.column(c).combine_chunks() for c in ("d", "v"))
        rows = np.repeat(np.arange(len(d)), d.value_lengths().to_numpy())
        model = fit_arrays(rows, d.flatten().to_numpy(), v.flatten().to_numpy().astype(float), got.column("grade").to_numpy().astype(int), levels)
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    sample = rated.mapInArrow(per_batch(sparse), "doc_id bigint, grade int, d array<int>, v array<float>")
    found = sample.groupBy().applyInArrow(fitted, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def score(docs: DataFrame, model: Model | None, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """doc_id, expected_grade, p_fair (grade >= 1), p_top (highest grade), selected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        t = m.tails(batch.column("text")) if m else np.full((batch.num_rows, 1), 0.5)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(t.sum(axis=1)), pa.array(t[:, 0]), pa.array(t[:, -1]), pa.array(t[:, 0] >= keep_tail)],
            names=["doc_id", "expected_grade", "p_fair", "p_top", "selected"],
        )

    return two_columns(docs).mapInArrow(per_batch(run), "doc_id bigint, expected_grade double, p_fair double, p_top double, selected boolean")


def select(docs: DataFrame, model: Model | None, keep_tail: float = KEEP_TAIL, text_col: str = "text") -> DataFrame:
    """The rows whose P(grade >= 1) reaches ``keep_tail``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        return batch if m is None else batch.filter(pa.array(m.tails(batch.column(text_col))[:, 0] >= keep_tail))

    return docs.mapInArrow(per_batch(run, col=text_col), docs.schema)
