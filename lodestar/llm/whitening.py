"""Whitening of embeddings by shifted CholeskyQR: principal components, scaled to unit variance.

Entries become whole numbers, so that equal vectors and sums are exact. The
components are fitted on the distinct vectors, and given for every row.

1. The distinct vectors are stored, and their number and sums found.
2. Each pass adds up the Gram matrix of the centred rows, after solving them
   with the triangular factors found so far; its Cholesky factor is the next
   one. The matrix of the first pass is shifted, so that it has a factor however
   badly conditioned the rows are, and so is any later one that needs it. The
   passes end when the rows are orthonormal to rounding.
3. The product R of the factors has the singular values and right vectors of
   the rows. Its SVD gives the components without the loss of half the digits
   that an eigendecomposition of the covariance means.
4. Each row is centred and projected; one more pass over the distinct vectors
   measures how far the whitened covariance is from the identity.

A pass sends a row per cell of a triangle and task through the shuffle, and a
triangle to the driver: (dimensions squared)/2 numbers, however many rows. A
row is centred as (n x - S) / n, where n x - S is exact.

Rows are dropped whose vector is null or empty, holds a null or non-finite
entry, or is shorter than the longest one (it lacks entries). An entry of 2^40
or more is refused with an error, as x would not be exact. Repeated vectors
count once in the fit, and each of their rows is in the result. Components of
no variance (equal or linearly dependent dimensions, a single vector) are left
out, as are all rows of an empty table. ``deviation`` is null where a long
cannot hold it. Columns other than the id and the vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lodestar.llm.common import column, prepare_workers
from lodestar.scratch import discard, materialise

#: Steps per unit of an entry, and what is added to make them positive.
SCALE, OFFSET = 64, 1_000_000
#: Entries from this size on are refused.
TOO_LARGE = float(1 << 40)
#: Components in the result.
COMPONENTS = 16
#: Passes after which what has not become orthonormal is taken as linearly dependent.
PASSES = 6
#: Standard deviations below this part of the largest count as none.
NO_VARIANCE = 1e-12
_LARGEST_LONG = float(1 << 62)
_ROUNDING = float(np.finfo(np.float64).eps) / 2


@dataclass(frozen=True)
class Centre:
    """How many vectors the fit has, and their sums."""

    n: int
    sums: np.ndarray

    def deviations(self, vectors: np.ndarray) -> np.ndarray:
        return self.n * vectors - self.sums

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        return self.deviations(vectors) / self.n


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``x`` (whole numbers) of the rows whose vector has all its entries."""
    vector = F.col("vector")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    entry = lambda c: F.when(F.abs(c) < TOO_LARGE, F.floor(c * SCALE) + OFFSET).otherwise(
        F.raise_error(F.lit("an entry is too large to be whitened exactly")).cast("bigint")
    )
    named = rows.select(
        column(rows, id_column).alias("id"), column(rows, vector_column).cast("array<double>").alias("vector")
    )
    return named.where(finite & (F.size(vector) > 0)).select("id", F.transform(vector, entry).alias("x"))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(
    vectors: DataFrame, width: int, measure: Callable[[np.ndarray], np.ndarray], kind: str
) -> dict[tuple[int, int], float]:
    """The matrices that ``measure`` makes of blocks of vectors, added up, as cells."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                part = measure(_matrix(batch["x"], width))
                held = part if held is None else held + part
        if held is not None:
            i, j = np.triu_indices(held.shape[0], m=held.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(j), pa.array(held[i, j])], names=["i", "j", "value"]
            )

    cells = vectors.select("x").mapInArrow(total, f"i bigint, j bigint, value {kind}")
    rows = cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    return {(r["i"], r["j"]): r["value"] for r in rows}


def _gram(vectors: DataFrame, width: int, project: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The Gram matrix of all rows after ``project``."""

    def measure(block: np.ndarray) -> np.ndarray:
        rows = project(block)
        return rows.T @ rows

    gram = np.zeros((size, size))
    for (i, j), value in _summed(vectors, width, measure, "double").items():
        gram[i, j] = gram[j, i] = value
    return gram


def solved(rows: np.ndarray, factors: Sequence[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each upper triangular factor, by substitution."""
    rows = np.asfortranarray(rows)
    for factor in factors:
        for j in range(rows.shape[1]):
            rows[:, j] -= rows[:, :j] @ factor[:j, j]
            rows[:, j] /= factor[j, j]
    return rows


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor, of a shifted matrix if wanted or needed."""
    width = len(gram)
    norm = float(np.linalg.norm(gram, 2))
    # beyond the rounding errors of the matrix, which grow with its terms at worst
    shift = min(11 * (n * width + width * (width + 1)) * _ROUNDING, 1e-6) * norm
    if not shifted and np.linalg.eigvalsh(gram)[0] > shift:
        return np.linalg.cholesky(gram).T
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift *= 100


def triangular_factor(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """A matrix R with the singular values and right singular vectors of the centred vectors."""
    width = len(centre.sums)
    factors: list[np.ndarray] = []
    composed = np.eye(width)
    for at in range(PASSES):
        known = tuple(factors)
        gram = _gram(vectors, width, lambda block: solved(centre.rows(block), known), width)
        if not gram.any():
            return np.zeros((width, width))
        if np.abs(gram - np.eye(width)).max() <= 1e-12 * width:
            break
        if at < PASSES - 1:
            factors.append(_factor(gram, centre.n, shifted=at == 0))
            composed = factors[-1] @ composed
    # what is left to orthonormal rows; dependent dimensions leave a matrix without Cholesky factor
    values, axes = np.linalg.eigh(gram)
    return np.sqrt(np.maximum(values, 0))[:, None] * (axes.T @ composed)


def principal_components(factor: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Unit eigenvectors as rows, eigenvalues and the trace of the covariance."""
    _, lengths, axes = np.linalg.svd(factor)
    kept = lengths[:most] > NO_VARIANCE * max(lengths[0], np.finfo(np.float64).tiny)
    axes = axes[:most][kept]
    # the same sign every time: the largest entry is positive
    largest = np.abs(axes).argmax(axis=1)
    axes = axes * np.sign(axes[np.arange(len(axes)), largest])[:, None]
    return axes, lengths[:most][kept] ** 2 / n, float((lengths**2).sum() / n)


def squared_deviations(centre: Centre, vectors: np.ndarray) -> pa.Array:
    """The sum of squares of n x - S of every row; null where a long cannot hold it."""
    apart = centre.deviations(vectors)
    fits = (apart.astype(np.float64) ** 2).sum(axis=1) < _LARGEST_LONG
    return pa.array((apart * apart).sum(axis=1), pa.int64(), mask=~fits)


def whiten(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per remaining row and component, numbered from 1 by falling variance."""
    prepare_workers(rows.sparkSession)
    whole = whole_vectors(rows, id_column, vector_column)
    schema = T.StructType(
        [
            T.StructField("id", whole.schema["id"].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    stored = materialise(whole.select("x").distinct(), "vectors")
    sizes = {r["width"]: r["count"] for r in stored.groupBy(F.size("x").alias("width")).count().collect()}
    width = max(sizes, default=0)
    vectors = stored.where(F.size("x") == width)
    axes = np.empty((0, width))
    if width:
        sums = _summed(vectors, width, lambda block: block.sum(axis=0, keepdims=True), "bigint")
        centre = Centre(sizes[width], np.array([sums[0, j] for j in range(width)], dtype=np.int64))
        factor = triangular_factor(vectors, centre)
        axes, variances, trace = principal_components(factor, centre.n, components)
    if not len(axes):
        discard(stored)
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_column)
    scaled = (axes / np.sqrt(variances)[:, None]).T
    covariance = _gram(vectors, width, lambda block: centre.rows(block) @ scaled, len(axes)) / centre.n
    error = float(np.abs(covariance - np.eye(len(axes))).max())
    discard(stored)
    explained = variances / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, count = _matrix(batch["x"], width), batch.num_rows
            repeated = pa.array(np.repeat(np.arange(count), len(scaled.T)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(repeated),
                    pa.array(np.tile(np.arange(1, len(axes) + 1, dtype=np.int32), count)),
                    pa.array(np.full(len(repeated), centre.n)),
                    squared_deviations(centre, block).take(repeated),
                    pa.array((centre.rows(block) @ scaled).ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(len(repeated), error)),
                ],
                names=schema.names,
            )

    return whole.where(F.size("x") == width).mapInArrow(project, schema).withColumnRenamed("id", id_column)
