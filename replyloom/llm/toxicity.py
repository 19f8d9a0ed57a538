"""Toxicity by compression distance with zstandard dictionaries.

One dictionary is trained on all windows of the sampled toxic texts, one on all windows of the
ordinary ones. A document is cut into overlapping windows of words; each is compressed with both, and
the gain of a window is how many bytes shorter the toxic dictionary makes it. A text's
features (the largest gain, the mean of its five largest, the share of windows with a clear
gain, the number of windows) go through a logistic calibration, so that 0.5 is the
threshold.

Windows of a toxic text are mostly ordinary, so a third dictionary goes with these two: stems of
words are weighed, and it is trained on the runs of toxic texts made of stems met in clearly
more toxic than ordinary labelled texts. It begins with the ordinary dictionary, so that ordinary
words cost the same; its gains are features as well. Matches of five bytes
count, so stems are met in words never seen in training.

Edge cases: NULL and empty texts have no windows and get the score of no gain; long
texts are windowed whole, in bounded batches; repeated rows are each scored; NULL labels
or ids take no part in training; other columns are ignored; an empty table gives an
empty result, and without both kinds of labels every score is 0.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from replyloom.llm import words as W
from replyloom.llm.common import per_batch, two_columns
from replyloom.session import cut_lineage

#: Bounds on labelled rows used for training (smallest id hashes), a class; the calibration weighs them as their class occurs.
SAMPLE_ROWS = 4000
#: Stems are STEM bytes inside a word; one is marked if at least MARK_SHARE of the toxic texts and
#: MARK_LIFT times that share of the ordinary ones have it. At most MARK_STEMS, commonest first.
STEM = 5
MARK_STEMS = 4000
MARK_SHARE, MARK_LIFT = 0.008, 20.0
DICT_BYTES = 8 << 10
WINDOW, STEP = 6, 5
CLEAR = 6


def windows(texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Windows of WINDOW words, STEP apart (a last shorter one), with single spaces, and
    the row of each."""
    w = W.words(texts, W.PLAIN)
    first, counts = w.bounds(), w.counts()
    n_win = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STEP)), 0)
    row = np.repeat(np.arange(len(counts)), n_win)
    k = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(n_win)))[:-1], n_win)
    a = first[row] + k * STEP
    b = np.minimum(a + WINDOW, first[row + 1])
    # runs of other characters become one space: words moved together in one buffer
    size = w.end - w.start + 1
    place = np.concatenate(([0], np.cumsum(size)))
    flat = np.full(int(place[-1]), 32, np.uint8)
    if len(size):
        shift = np.repeat(w.start - place[:-1], size)
        src = np.arange(len(flat)) + shift
        body = np.ones(len(flat), bool)
        body[place[1:] - 1] = False
        flat[body] = w.buf[src[body]]
    data = flat.tobytes()
    return [data[x:y] for x, y in zip(place[a].tolist(), place[b].tolist(), strict=True)], row


def stems(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of STEM bytes inside words, packed into numbers, with their row and place."""
    n = len(w.buf) - STEM + 1
    if n <= 0 or not len(w.start):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    ok = np.zeros(len(w.buf) + 1, np.int64)
    long = w.end - w.start >= STEM
    np.add.at(ok, w.start[long], 1)
    np.add.at(ok, w.end[long] - STEM + 1, -1)
    at = np.flatnonzero(np.cumsum(ok)[:-1] > 0)
    value = np.zeros(len(at), np.uint64)
    for i in range(STEM):
        value = (value << np.uint64(8)) | w.buf[at + i].astype(np.uint64)
    return value, np.searchsorted(w.base, at, side="right") - 1, at


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    marked: bytes
    weights: np.ndarray

    def compressors(self):
        import zstandard as z

        params = z.ZstdCompressionParameters(
            window_log=16, hash_log=14, chain_log=14, search_log=4, min_match=5, target_length=16, strategy=z.STRATEGY_LAZY,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        out = []
        for data in (self.toxic, self.marked, self.ordinary):
            d = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            out.append(z.ZstdCompressor(dict_data=d, compression_params=params))
        return out

    def gains(self, parts: list[bytes]) -> list[np.ndarray]:
        """Bytes saved against the ordinary dictionary: by the marked runs, by the toxic one."""
        if not hasattr(self, "_c"):
            self._c = self.compressors()
        out = []
        for c in self._c:
            f = c.compress
            out.append(np.fromiter((len(f(p)) for p in parts), np.int64, len(parts)))
        toxic, marked, ordinary = out
        return [ordinary - marked, ordinary - toxic]

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "marked": self.marked, "weights": self.weights}

    def features(self, texts: pa.Array) -> np.ndarray:
        n = len(texts)
        parts, row = windows(texts)
        out = np.zeros((n, 8))
        out[:, 7] = 1
        if not parts:
            return out
        count = np.bincount(row, minlength=n)
        for k, gain in enumerate(self.gains(parts)):
            gain = gain.astype(float)
            order = np.lexsort((-gain, row))
            rank = np.arange(len(row)) - np.searchsorted(row[order], row[order])
            lead = order[rank == 0]
            out[row[lead], 3 * k] = gain[lead]
            five = rank < 5
            out[:, 3 * k + 1] = np.bincount(row[order][five], gain[order][five], minlength=n) / np.maximum(np.minimum(count, 5), 1)
            out[:, 3 * k + 2] = 10 * np.bincount(row, gain >= CLEAR, minlength=n) / np.maximum(count, 1)
        out[:, 6] = np.log2(1 + count)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-self.features(texts) @ self.weights, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> np.ndarray:
    """Newton steps with a small ridge; ``weight`` is how many rows each one stands for."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(-x @ w, -50, 50)))
        h = x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (weight * (p - y)) + 1e-2 * w)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def training_labels(labels: DataFrame, fold: int) -> DataFrame:
    """doc_id, toxic, without the held-out remainder."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    return known.filter(F.crc32(F.col("doc_id").cast("string")) % fold != 0)


def sample(docs: DataFrame, train: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` of the training labels a class, with their texts."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = train.filter("toxic = 1").orderBy(*order).limit(rows).unionByName(train.filter("toxic = 0").orderBy(*order).limit(rows))
    rated = two_columns(docs).join(F.broadcast(chosen), "doc_id")
    # copies of a text tell nothing new
    first = rated.groupBy(F.xxhash64("text").alias("_hash")).agg(F.min("doc_id").alias("doc_id"))
    return cut_lineage(rated.join(F.broadcast(first.select("doc_id").distinct()), "doc_id", "left_semi").repartition(16), "toxic-sample")


def _content(samples: list[bytes]) -> bytes:
    """What zstandard's dictionary training chooses from the samples; with too few of them, their ends."""
    import zstandard as z

    try:
        data = z.train_dictionary(DICT_BYTES, samples).as_bytes()
        return data[-DICT_BYTES // 2 :]
    except z.ZstdError:
        return b"".join(samples)[-DICT_BYTES // 2 :]


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, fold: int = 5) -> Model | None:
    known = training_labels(labels, fold)
    chosen = sample(docs, known, rows)
    # where the bound cuts a class, its rows stand for all of it: 0.5 means the same at every size
    stands_for = {r.toxic: max(1.0, r.n / rows) for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def met(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Distinct stems of each text, counted by label."""
        stem, row, _ = stems(W.words(batch.column("text"), W.PLAIN))
        d, v, _ = W.distinct_in_doc(row, stem)
        tox = np.asarray(batch.column("toxic").to_numpy(zero_copy_only=False))[d]
        h, where = np.unique(v, return_inverse=True)
        n1, n0 = (np.bincount(where, tox == k, minlength=len(h)).astype(np.int64) for k in (1, 0))
        return pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n1), pa.array(n0)], names=["stem", "n1", "n0"])

    sizes = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    share1, share0 = F.col("n1") / sizes[1], (F.col("n0") + 0.5) / sizes[0]
    marks = (
        chosen.mapInArrow(per_batch(met), "stem bigint, n1 bigint, n0 bigint").groupBy("stem").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        .filter((F.col("n1") >= 3) & (share1 >= MARK_SHARE) & (share1 >= MARK_LIFT * share0)).orderBy(F.desc("n1"), "stem").limit(MARK_STEMS).collect()
    )
    marked_stems = np.array(sorted(r.stem for r in marks), np.uint64)

    def parts(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Training samples: every window of every text by its label, and the marked runs of each toxic text in order (kind 2)."""
        w = W.words(batch.column("text"), W.PLAIN)
        stem, row, at = stems(w)
        place = np.minimum(np.searchsorted(marked_stems, stem), max(len(marked_stems) - 1, 0))
        found = np.flatnonzero(marked_stems[place] == stem) if len(marked_stems) and len(stem) else np.zeros(0, np.int64)
        covered = np.zeros(len(w.buf) + 1, np.int64)
        np.add.at(covered, at[found], 1)
        np.add.at(covered, at[found] + STEM, -1)
        covered = np.cumsum(covered) > 0
        tox = batch.column("toxic").to_numpy(zero_copy_only=False)
        out, of = windows(batch.column("text"))
        kind = tox[of].tolist()
        for r in np.flatnonzero(tox == 1):
            a, b = int(w.base[r]), int(w.base[r + 1])
            flags = covered[a:b]
            if flags.any():
                text = np.where(flags, w.buf[a:b], 32).astype(np.uint8).tobytes()
                out.append(b" " + b" ".join(text.split()) + b" "), kind.append(2)
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(kind, pa.int32())], names=["part", "kind"])

    got = chosen.mapInArrow(per_batch(parts), "part binary, kind int").toArrow().sort_by([("kind", "ascending"), ("part", "ascending")])
    kinds, data = got.column("kind").to_numpy(), got.column("part").to_pylist()
    by = {k: [data[i] for i in np.flatnonzero(kinds == k)] for k in (0, 1, 2)}
    if not by[1] or not by[0]:
        return None
    ordinary = _content(by[0])
    # the commonest runs come last, nearest to the text
    runs = Counter(x for part in by[2] for x in part.split())
    lead = b" ".join(x for x, _ in sorted(runs.items(), key=lambda kv: (kv[1], kv[0])))[-DICT_BYTES // 2 :]
    marked = ordinary + (_content(by[2]) if by[2] else b"") + b" " + lead + b" "
    model = Model(_content(by[1]), ordinary, marked, np.zeros(8))

    def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = model.features(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *[pa.array(x[:, i]) for i in range(8)]], names=["doc_id", "toxic", *"abcdefgh"])

    got = chosen.mapInArrow(per_batch(measured), "doc_id bigint, toxic int, " + ", ".join(f"{c} double" for c in "abcdefgh")).toArrow().sort_by([(c, "ascending") for c in ("doc_id", *"abcdefgh")])
    x = np.stack([got.column(c).to_numpy() for c in "abcdefgh"], axis=1)
    y = got.column("toxic").to_numpy()
    model.weights = _logistic(x, y.astype(float), np.where(y == 1, stands_for[1], stands_for[0]))
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score (0 to 1), windows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        got = m.score(batch.column("text")) if m else np.zeros(batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got)], names=["doc_id", "score"])

    return two_columns(docs).mapInArrow(per_batch(run), "doc_id bigint, score double")
