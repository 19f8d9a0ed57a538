"""Light classifier over embeddings, and simpler relatives of it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from replyloom.domain import EMBED_MODEL, INTENTS
from replyloom.functions.numeric import half_even
from replyloom.functions.settle import settle
from replyloom.functions.text import domain_code, murmur3
from replyloom.session import cut_lineage

# Inverse regularisation strength and iteration limit of the fit.
C = 10.0
MAX_ITER = 2000
# relative change of the loss at which the fit ends
TOLERANCE = 1e-9


def with_features(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(embedding).cast("array<double>")))


def text_features(df: DataFrame, text: str = "text", n: int = 3, dims: int = 1 << 12) -> DataFrame:
    """Hashed character n-grams of the lower-cased text, for when no vectors are at hand. Characters are code
    points; a NULL text has none. The vectors are those that ``HashingTF`` makes of the grams of ``NGram``: a
    gram is its characters with a space between."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}
        for batch in batches:
            parts = [_gram_counts(batch[at : at + _TEXTS], n, dims, known) for at in range(0, len(batch), _TEXTS)]
            yield pa.concat_arrays(parts)

    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return settle(df, {"features": F.arrow_udf(run, VectorUDT())(lowered)})


#: Texts counted at a time, and codes that are numbered by a table.
_TEXTS, _TABLE = 256, 1 << 22


def _numbered(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of ``codes`` below ``size``, and the place of each code among them."""
    if size > _TABLE:
        return np.unique(codes, return_inverse=True)
    place = np.zeros(size, np.int32)
    place[codes] = 1
    distinct = np.flatnonzero(place)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[codes]


def _gram_counts(texts: pa.Array, n: int, dims: int, known: dict[str, int]) -> pa.StructArray:
    """Sparse vectors, as Spark stores them, of how often the n-grams of each text fall on each dimension."""
    plain = texts.to_pylist()
    points = np.frombuffer("".join(plain).encode("utf-32-le"), "<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(plain)), [len(t) for t in plain])
    chars, char = _numbered(points, 0x110000)
    letters = [chr(c) for c in chars.tolist()]
    size = max(len(points) - n + 1, 0)
    inside = doc[:size] == doc[len(doc) - size :]
    # grams of one character more each time
    grams, gram = letters, char[:size][inside]
    for k in range(1, n):
        pairs, gram = _numbered(gram.astype(np.int64) * len(letters) + char[k : k + size][inside], len(grams) * len(letters))
        grams = [f"{grams[p // len(letters)]} {letters[p % len(letters)]}" for p in pairs.tolist()]
    if len(known) > _TABLE // 8:
        known.clear()
    for g in grams:
        if g not in known:
            known[g] = murmur3(g.encode()) % dims
    found = np.bincount(doc[:size][inside] * dims + np.array([known[g] for g in grams], np.int64)[gram], minlength=len(plain) * dims)
    at = np.flatnonzero(found)
    ends = pa.array(np.searchsorted(at, np.arange(len(plain) + 1) * dims), pa.int32())
    return pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(len(plain), np.int8)), pa.array(np.full(len(plain), dims, np.int32)),
            pa.ListArray.from_arrays(ends, pa.array((at % dims).astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(found[at].astype(float))),
        ],
        names=["type", "size", "indices", "values"],
    )


@dataclass
class Classifier:
    """Fitted model with what is needed to use and audit it."""

    model: PipelineModel
    classes: tuple[str, ...]
    embed_model: str
    n_train: int
    train_accuracy: float

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        meta = [(list(self.classes), self.embed_model, self.n_train, self.train_accuracy)]
        schema = "classes array<string>, embed_model string, n_train bigint, train_accuracy double"
        spark.createDataFrame(meta, schema).write.mode("overwrite").parquet(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Classifier":
        meta = spark.read.parquet(f"{path}/metadata").first()
        return cls(
            PipelineModel.load(f"{path}/model"),
            tuple(meta["classes"]),
            meta["embed_model"],
            meta["n_train"],
            meta["train_accuracy"],
        )

    def predict(self, df: DataFrame) -> DataFrame:
        """Add micro_label, max_proba and the class to probability map."""
        scored = self.model.transform(df)
        p = vector_to_array("probability")
        names = F.array(*[F.lit(c) for c in self.classes])
        return (
            scored.withColumn("_p", p)
            .withColumn("max_proba", F.array_max("_p"))
            .withColumn("micro_label", F.element_at(names, F.array_position("_p", F.col("max_proba")).cast("int")))
            .withColumn("proba", F.map_from_arrays(names, F.col("_p")))
            .drop("_p", "probability", "rawPrediction", "prediction")
        )


def train_classifier(
    df: DataFrame,
    *,
    label: str = "label",
    classes=tuple(sorted(INTENTS)),
    c: float = C,
    max_iter: int = MAX_ITER,
    embed_model: str = EMBED_MODEL,
) -> Classifier:
    """Multinomial logistic regression by L-BFGS. The penalty 1/(C*n) on the mean
    loss is the usual C on the summed loss; features are not rescaled."""
    rows = with_features(df.filter(F.col(label).isin(*classes))).select(
        "features", (domain_code(F.col(label), classes) - 1).cast("double").alias("_y")
    )
    n = rows.count()
    lr = LogisticRegression(
        labelCol="_y", featuresCol="features", family="multinomial", regParam=1.0 / (c * max(n, 1)),
        elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=TOLERANCE,
    )
    model = Pipeline(stages=[lr]).fit(rows)
    hits = model.transform(rows).agg(F.avg((F.col("prediction") == F.col("_y")).cast("double"))).first()[0]
    return Classifier(model, tuple(classes), embed_model, n, float(hits or 0.0))


@dataclass
class Optimality:
    """Penalised mean loss at a classifier's weights and the largest absolute entry of its
    gradient there: zero at the one optimum, so a small one proves the fit."""

    loss: float
    gradient: float


def optimality(fitted: Classifier, df: DataFrame, label: str = "label", c: float = C) -> Optimality:
    """Judge saved weights by the rows they were fitted on, whatever fitted them: one pass, summed where
    rows are read; the driver sees as many numbers as there are weights."""
    rows = fitted.model.transform(with_features(df.filter(F.col(label).isin(*fitted.classes))))
    p, x = vector_to_array("probability"), F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    right = domain_code(F.col(label), fitted.classes)
    rows = settle(rows.select(p.alias("_p"), x.alias("_x"), right.alias("_y")), {"_miss": F.transform("_p", lambda q, k: q - F.when(k == F.col("_y") - 1, 1.0).otherwise(0.0))})
    times = lambda miss: F.transform("_x", lambda e: e * miss)
    by_class = [times(F.col("_miss")[k]) for k in range(len(fitted.classes))]
    mean, loss, n = rows.agg(Summarizer.mean(array_to_vector(F.concat(*by_class))), F.avg(-F.ln(F.get("_p", F.col("_y") - 1))), F.count(F.lit(1))).first()
    weights = fitted.model.stages[-1].coefficientMatrix.toArray()
    penalty = 1.0 / (c * max(n, 1))
    gradient = np.asarray(mean.toArray()).reshape(len(fitted.classes), -1)
    gradient[:, :-1] += penalty * weights
    return Optimality(float(loss) + penalty * float((weights**2).sum()) / 2, float(np.abs(gradient).max()))


def class_centroids(df: DataFrame, label: str = "label", embedding: str = "embedding", classes=INTENTS) -> DataFrame:
    """Mean vector per known class, aggregated partially on the map side."""
    vec = array_to_vector(F.col(embedding).cast("array<double>"))
    return df.filter(F.col(label).isin(*classes)).groupBy(F.col(label).alias("label")).agg(vector_to_array(Summarizer.mean(vec)).alias("centroid"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def centroid_classify(df: DataFrame, centroids: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Class of the most similar centroid; ties to the smaller label. There is one
    centroid per class, so all of them travel as one array value, already of length one."""
    length = F.sqrt(_dot(F.col("centroid"), F.col("centroid")))
    unit = F.transform("centroid", lambda x: F.coalesce(F.try_divide(x, length), F.lit(0.0)))
    one = centroids.agg(F.collect_list(F.struct("label", unit.alias("centroid"))).alias("_centroids"))
    rows = settle(df.join(F.broadcast(one)), {"_vec": F.col(embedding).cast("array<double>")})
    rows = settle(rows, {"_norm": F.sqrt(_dot(F.col("_vec"), F.col("_vec")))})
    scored = F.transform("_centroids", lambda c: F.struct(F.coalesce(F.try_divide(_dot(F.col("_vec"), c["centroid"]), F.col("_norm")), F.lit(0.0)).alias("sim"), c["label"].alias("label")))
    rows = settle(rows, {"_scored": scored}, drop=("_vec", "_norm", "_centroids"))
    best = F.aggregate(
        "_scored",
        F.get("_scored", F.lit(0)),
        lambda a, b: F.when((b["sim"] > a["sim"]) | ((b["sim"] == a["sim"]) & (b["label"] < a["label"])), b).otherwise(a),
    )
    return settle(rows, {"_best": best}, drop=("_scored",)).withColumn("centroid_label", F.col("_best.label")).withColumn(
        "similarity", half_even(F.col("_best.sim"))
    ).drop("_best")


KNN_ROWS = 20_000
RANGE_POINTS = 100_000


def knn_classify(
    df: DataFrame,
    train: DataFrame,
    *,
    k: int = 5,
    key: str = "id",
    label: str = "label",
    embedding: str = "embedding",
    max_train: int = KNN_ROWS,
    skip_self: bool = False,
) -> DataFrame:
    """Majority class of the ``k`` most cosine-similar training rows.

    At most ``max_train`` labelled rows serve as training side, those with the smallest key
    hashes; they are broadcast as one matrix. Rows to classify are scored where they are
    read: no shuffle, and similarities of a slice of rows at a time. Ties go to the
    smaller key, then the smaller label.
    """
    chosen = train.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).cast("bigint").alias("t_key"), F.col(label).alias("t_label"), F.col(embedding).alias("t_vec"))
    rows = chosen.orderBy(F.xxhash64("t_key"), "t_key").limit(max_train).toPandas().sort_values(["t_key", "t_label"], ignore_index=True)

    def unit(vs) -> np.ndarray:
        m = np.stack(vs.to_numpy()).astype("float64")
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)

    side = (unit(rows["t_vec"]) if len(rows) else np.zeros((0, 1)), rows["t_key"].to_numpy(), rows["t_label"].to_numpy())
    shared = df.sparkSession.sparkContext.broadcast(side)
    out_key = df.schema[key].dataType.simpleString()

    def nearest(frames):
        matrix, keys, labels = shared.value
        names = sorted(set(labels.tolist()))
        code = np.array([names.index(x) for x in labels.tolist()], int)
        for frame in frames:
            for i in range(0, len(frame) if len(keys) else 0, 256):
                part = frame.iloc[i : i + 256]
                sim = np.round(unit(part["vec"]) @ matrix.T, 9)
                if skip_self:
                    sim[part["key"].to_numpy()[:, None] == keys[None, :]] = -np.inf
                n = min(k, sim.shape[1])
                # the k-th best value, then everything that reaches it: ties are settled by key below
                least = -np.partition(-sim, n - 1, axis=1)[:, n - 1]
                votes, winner = [], []
                for row, low in zip(sim, least):
                    near = np.flatnonzero((row >= low) & np.isfinite(row))
                    best = near[np.argsort(-row[near], kind="stable")][:k]
                    count = np.bincount(code[best], minlength=len(names))
                    votes.append(int(count.max()) if len(best) else 0)
                    winner.append(names[int(count.argmax())] if len(best) else None)
                yield pd.DataFrame({key: part["key"].to_numpy(), "knn_label": winner, "votes": votes})

    return df.select(F.col(key).alias("key"), F.col(embedding).alias("vec")).mapInPandas(nearest, f"{key} {out_key}, knn_label string, votes bigint")


def _bounds(df: DataFrame, col: str, n: int, offset: float, per_range: int) -> list[float]:
    """Bounds between value ranges of ``col`` of about ``per_range`` rows; with ``offset`` 0.5 they lie
    amid the ranges without it."""
    count = -(-n // per_range)
    if count < 2:
        return []
    at = F.array(*[F.lit((i + offset) / count) for i in range(0 if offset else 1, count)])
    return sorted(set(df.agg(F.percentile_approx(col, at, 20 * count)).first()[0]))


def _in_range(df: DataFrame, col: str, bounds: list[float], name: str) -> DataFrame:
    """Add the number of the range that ``col`` falls into."""
    if not bounds:
        return df.withColumn(name, F.lit(0))
    split = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol=col, outputCol=name)
    return split.transform(df).withColumn(name, F.col(name).cast("int"))


def _pool(frame: pd.DataFrame) -> pd.DataFrame:
    """Pool neighbours whose means do not rise; whole-number comparisons."""
    frame = frame.sort_values("lo")
    out: list[list] = []
    for lo, hi, hits, w in zip(frame["lo"].tolist(), frame["hi"].tolist(), frame["hits"].tolist(), frame["w"].tolist()):
        while out and out[-1][2] * w >= hits * out[-1][3]:
            last = out.pop()
            lo, hits, w = last[0], hits + last[2], w + last[3]
        out.append([lo, hi, hits, w])
    pooled = pd.DataFrame(out, columns=["lo", "hi", "hits", "w"])
    pooled["_r"] = frame["_r"].iloc[0]
    return pooled


def _rising_blocks(points: DataFrame, n: int, per_range: int) -> DataFrame:
    """lo, hi, hits, w: blocks of neighbouring values with rising means.

    Value ranges are pooled side by side; what is pooled never splits again, so blocks take the
    place of their points and pooling goes on, with bounds moved by half a range each round, until
    no two neighbours across a bound fall. The driver sees the outer blocks of each range.
    """
    blocks, offset = points.select(F.col("_x").alias("lo"), F.col("_x").alias("hi"), "hits", "w"), 0.0
    while True:
        bounds = _bounds(blocks, "lo", n, offset, per_range)
        ranged = _in_range(blocks, "lo", bounds, "_r")
        blocks = cut_lineage(ranged.groupBy("_r").applyInPandas(_pool, "lo double, hi double, hits bigint, w bigint, _r int"), "blocks")
        ends = [F.struct(fn(F.struct("hits", "w"), "lo").alias("b")).alias(name) for fn, name in ((F.min_by, "first"), (F.max_by, "last"))]
        edges = blocks.groupBy("_r").agg(*ends, F.count(F.lit(1)).alias("n")).orderBy("_r").collect() if bounds else []
        falls = any(a["last"].b.hits * b["first"].b.w >= b["first"].b.hits * a["last"].b.w for a, b in zip(edges, edges[1:]))
        blocks = blocks.drop("_r")
        if not falls:
            return blocks
        n, offset = sum(e["n"] for e in edges), 0.5 - offset


def calibrate(results: DataFrame, hit: Column, value: str = "confidence", range_points: int = RANGE_POINTS) -> DataFrame:
    """Isotonic map from confidence to accuracy, one row per distinct confidence; exact, whatever their number.

    Rows are folded to counts per confidence first, and confidences are pooled by ranges of about
    ``range_points`` of them, so no task holds more than that many blocks. Each confidence then
    finds its block within its range; a block that reaches over several ranges is there in each.
    Rows without a confidence, or with one that is not a number, do not count.
    """
    x = F.col(value).cast("double")
    folded = results.filter(x.isNotNull() & ~F.isnan(x)).groupBy(x.alias("_x")).agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("w"))
    points = cut_lineage(folded, "calibrate")
    n = points.count()
    blocks = _rising_blocks(points, n, range_points)
    bounds = _bounds(points, "_x", n, 0.0, range_points)
    ends = _in_range(_in_range(blocks, "lo", bounds, "_from"), "hi", bounds, "_to")
    steps = ends.select(F.explode(F.sequence("_from", "_to")).alias("_s"), "lo", "hits", "w")

    def look_up(rows: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("lo", ignore_index=True)
        at = np.searchsorted(blocks["lo"].to_numpy(), rows["_x"].to_numpy(), side="right") - 1
        return pd.DataFrame({"_x": rows["_x"], "hits": rows["hits"], "w": rows["w"], "fit": (blocks["hits"] / blocks["w"]).to_numpy()[at]})

    fitted = _in_range(points, "_x", bounds, "_r").groupBy("_r").cogroup(steps.groupBy("_s")).applyInPandas(look_up, "_x double, hits bigint, w bigint, fit double")
    return fitted.select(
        F.col("_x").alias(value), F.col("w").alias("n"), half_even(F.col("hits") / F.col("w")).alias("accuracy"), half_even(F.col("fit")).alias("calibrated")
    )
