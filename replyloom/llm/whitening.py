"""Whitening of vectors with distributed block matrices.

Rows are indexed and centred, dealt out as blocks of a ``BlockMatrix``, and its transpose times
itself gives the scatter matrix; its eigenvectors are found on the driver (``d`` x ``d`` numbers,
``MAX_DIMS`` at most), and the block matrix times the whitening matrix projects every row.

Vectors are whole numbers, so counts and sums are exact and ``n*x - S``, from which each row is
centred, has no rounding. The product's middle dimension, which is as long as the table, is split
over tasks of ``SPLIT_BLOCKS`` blocks each; partial products are summed. A block holds
``BLOCK_ROWS`` rows; the driver plans the product from the coordinates of the blocks.

Defined results: a vector that is NULL, empty, or holds a NULL or non-finite entry is left out,
and so is one whose length is not the commonest (of equally common ones, the greatest). Ids may be
NULL or repeat: every remaining row gives rows of its own. A component whose eigenvalue is no
more than rounding error of the greatest has no direction to whiten: its values are NULL, and it
does not count in the identity error. Where all rows are equal, shares explained are NULL too.
With fewer dimensions than components there are as many components as dimensions. Empty tables
give empty results. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replyloom.session import cut_lineage

COMPONENTS, MAX_DIMS = 8, 4096
BLOCK_ROWS, BLOCK_COLS, SPLIT_BLOCKS = 4096, 1024, 16


def grid(vector: Column, scale: float = 1024.0, shift: int = 100_000) -> Column:
    """Entries as whole numbers: floor(scale * entry) + shift; NULL for vectors to leave out."""
    finite = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    on_grid = F.transform(vector, lambda e: F.floor(e.cast("double") * F.lit(scale)).cast("bigint") + F.lit(shift).cast("bigint"))
    return F.when(finite & (F.size(vector) > 0), on_grid)


@dataclass
class Whitening:
    """What was fitted: row count, sums by dimension, eigenvalues (falling), their trace, and
    for each component a column that centred rows are multiplied by (NaN: no variance)."""

    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    matrix: np.ndarray


def _indexed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, x, index: a number for every row that has a vector.

    A row's place in its written partition is stored with it, and partitions are numbered through
    by their counts, one row for each task that wrote. Rows of other lengths leave gaps in the
    numbers, which stand for rows of zeros in a centred matrix and change no product.
    """
    named = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x")).filter("x is not null and size(x) > 0")
    at = F.monotonically_increasing_id()
    rows = cut_lineage(named.withColumn("part", F.shiftright(at, 33).cast("int")).withColumn("pos", at.bitwiseAND(F.lit((1 << 33) - 1))), "vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    first = counts.select("part", (F.sum("c").over(W.orderBy("part")) - F.col("c")).alias("first"))
    same = rows.filter(F.size("x") == (sizes["d"] if sizes else 0))
    return same.join(F.broadcast(first), "part").select("id", "x", (F.col("first") + F.col("pos")).alias("index"))


def _sums(rows: DataFrame) -> tuple[int, int, np.ndarray]:
    """Number of rows, one more than the greatest index, and exact sums by dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, top, total = 0, 0, None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).sum(axis=0)
                n, total = n + batch.num_rows, x if total is None else total + x
                top = max(top, int(batch.column(0).to_numpy().max()) + 1)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "top": [top], "s": [total.tolist()]}, pa.schema([("n", pa.int64()), ("top", pa.int64()), ("s", pa.list_(pa.int64()))]))

    partial = rows.select("index", "x").mapInArrow(add, "n bigint, top bigint, s array<bigint>").select("n", "top", F.posexplode("s"))
    found = partial.groupBy("pos").agg(F.sum("n").alias("n"), F.max("top").alias("top"), F.sum("col").alias("s")).orderBy("pos").collect()
    if not found:
        return 0, 0, np.zeros(0, np.int64)
    return found[0]["n"], found[0]["top"], np.array([r["s"] for r in found], np.int64)


def _offset(n: int, sums: np.ndarray) -> Column:
    """n*x - S of a row, exact."""
    s = F.array(*[F.lit(int(v)) for v in sums]).cast("array<bigint>")
    return F.zip_with("x", s, lambda a, b: a * F.lit(n).cast("bigint") - b)


def _blocks(rows: DataFrame, n: int, top: int, sums: np.ndarray) -> BlockMatrix:
    """Centred rows as blocks; what makes it is lazy."""
    centred = F.transform(_offset(n, sums), lambda d: d.cast("double") / F.lit(float(n)))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(centred).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, top, len(sums)).toBlockMatrix(min(BLOCK_ROWS, top), min(BLOCK_COLS, len(sums)))


def _gram(blocks: BlockMatrix) -> np.ndarray:
    """The matrix transposed times itself, on the driver.

    The result has one block (or few), to which a plain product would send all rows; splitting
    the middle dimension sums partial products of some blocks each. Python's ``multiply`` has no
    argument for that number, hence the call through its wrapper.
    """
    splits = max(1, math.ceil(blocks.numRowBlocks / SPLIT_BLOCKS))
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def fit(blocks: BlockMatrix, n: int, sums: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Whitening of centred rows: eigenvectors of their covariance (divisor n) by eigenvalue."""
    if len(sums) > MAX_DIMS:
        raise ValueError(f"{len(sums)} dimensions; at most {MAX_DIMS} are decomposed on the driver")
    covariance = _gram(blocks) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    rank = values > len(sums) * np.finfo(float).eps * max(values[0], 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        matrix = np.where(rank, vectors * np.sign(largest) / np.sqrt(values), np.nan)
    return Whitening(n, sums, values, float(np.trace(covariance)), matrix)


def _project(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """index, whitened: centred rows times the whitening matrix, which is as small as the model."""
    k, step = matrix.shape[1], blocks.colsPerBlock
    spark = blocks.blocks.ctx
    parts = [matrix[i : i + step] for i in range(0, len(matrix), step)]
    small = [((i, 0), DenseMatrix(len(p), k, p.ravel(order="F").tolist())) for i, p in enumerate(parts)]
    product = blocks.multiply(BlockMatrix(spark.parallelize(small, 1), step, k, len(matrix), k))
    rows = product.toIndexedRowMatrix().rows.map(lambda r: (r.index, [float(v) for v in r.vector.toArray()]))
    return rows.toDF("index bigint, whitened array<double>")


def _identity_error(projected: DataFrame, kept: list[int]) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    pairs = [(a, b) for a in kept for b in kept if a <= b]
    if not pairs:
        return None
    found = projected.select(*[F.col("whitened")[c].alias(f"w{c}") for c in kept]).agg(*[F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs, strict=True))


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "x", components: int = COMPONENTS) -> DataFrame:
    """id, n, deviation, whitened (an array over components), explained (likewise), identity_error
    for every remaining row. ``vector_col``: whole numbers (see ``grid``). ``deviation`` is the exact
    sum of (n*x - S)^2 over dimensions.
    """
    rows = _indexed(vectors, id_col, vector_col)
    n, top, sums = _sums(rows)
    schema = "id {}, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if not n:
        return rows.sparkSession.createDataFrame([], schema.format(dict(rows.dtypes)["id"]))
    blocks = _blocks(rows, n, top, sums)
    model = fit(blocks, n, sums, components)
    kept = [c for c in range(model.matrix.shape[1]) if not np.isnan(model.matrix[:, c]).any()]
    projected = cut_lineage(_project(blocks, np.nan_to_num(model.matrix)), "whitened")
    error = _identity_error(projected.join(rows.select("index"), "index", "left_semi"), kept)
    shares = F.array(*[F.lit(float(v / model.trace) if model.trace > 0 else None).cast("double") for v in model.eigenvalues])
    zero = F.lit(0).cast("decimal(38,0)")
    square = lambda acc, d: (acc + (d.cast("decimal(19,0)") * d.cast("decimal(19,0)")).cast("decimal(38,0)")).cast("decimal(38,0)")
    white = F.array(*[F.col("whitened")[c] if c in kept else F.lit(None).cast("double") for c in range(model.matrix.shape[1])])
    return rows.join(projected, "index").select(
        "id", F.lit(n).cast("bigint").alias("n"), F.aggregate(_offset(n, sums), zero, square).alias("deviation"),
        white.alias("whitened"), shares.alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
