"""Means, covariance and principal components."""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..blocks import merged, rows_of
from ..functions.numeric import dot
from ..functions.vectors import as_vector, dense_array

# Up to this width every pair of columns is its own aggregate of one pass.
_PAIRWISE_WIDTH = 16
# Up to so many numbers, components are written out as sums in generated code.
_WRITTEN_OUT = 1024


@dataclass(frozen=True)
class Moments:
    """Row count, means and covariance (divided by n) of the columns of a vector."""

    count: int
    mean: np.ndarray
    covariance: np.ndarray


def _uneven(width: int) -> ValueError:
    return ValueError(f"every row needs {width} numbers, none of them NULL")


def _pairwise_moments(df: DataFrame, features: str, width: int) -> Moments:
    values = dense_array(df, features)
    rows = df.select(
        F.size(values).alias("width"), *[F.get(values, F.lit(i)).alias(f"x{i}") for i in range(width)]
    )
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    row = rows.agg(
        F.count(F.lit(1)),
        F.min("width"),
        F.max("width"),
        F.array(*[F.count(f"x{i}") for i in range(width)]),
        *[F.avg(f"x{i}") for i in range(width)],
        *[F.covar_pop(f"x{i}", f"x{j}") for i, j in pairs],
    ).first()
    if row[0] == 0:
        raise ValueError("no rows")
    if not row[1] == row[2] == width or min(row[3]) < row[0]:
        raise _uneven(width)
    covariance = np.empty((width, width))
    for (i, j), value in zip(pairs, row[4 + width :]):
        covariance[i, j] = covariance[j, i] = value
    return Moments(row[0], np.array(row[4 : 4 + width]), covariance)


_PARTIAL = "n long, uneven boolean, mean binary, spread binary"
# Partial results that one task adds up.
_FAN_IN = 8


def _tree(partial: DataFrame, merge: Callable) -> DataFrame:
    """One row out of the rows of all tasks, a few of which are merged at a time.

    ``merge`` takes an iterator of batches to one of one batch.
    """
    parts = partial.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // _FAN_IN)
        partial = partial.repartition(parts).mapInArrow(merge, partial.schema)
    return partial


def _one_pass(df: DataFrame, features: str, width: int, squares: bool) -> tuple:
    """(n, uneven, mean, spread) of all rows, each of which is read once."""
    shape = (width,) if squares else (width, width)
    nothing = (0, False, np.zeros(width), np.zeros(shape))

    def packed(state):
        n, uneven, mean, spread = state
        return pa.RecordBatch.from_pydict(
            {"n": [int(n)], "uneven": [bool(uneven)], "mean": [mean.tobytes()], "spread": [spread.tobytes()]}
        )

    def measure(batches):
        state = nothing
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = rows_of(batch.column(0), width)
            if rows is None:
                state = (state[0] + batch.num_rows, True, *state[2:])
                continue
            mean = rows.mean(0)
            centered = rows - mean
            # What rounding left of the mean is taken out as well.
            rest = centered.mean(0)
            centered -= rest
            spread = (centered * centered).sum(0) if squares else centered.T @ centered
            state = merged(state, (len(rows), False, mean + rest, spread))
        yield packed(state)

    def merge(batches):
        state = nothing
        for batch in batches:
            for row in batch.to_pylist():
                mean, spread = np.frombuffer(row["mean"]), np.frombuffer(row["spread"]).reshape(shape)
                state = merged(state, (row["n"], row["uneven"], mean, spread))
        yield packed(state)

    partial = df.select(dense_array(df, features).alias("v")).mapInArrow(measure, _PARTIAL)
    row = _tree(partial, merge).first()
    if row is None or row["n"] == 0:
        raise ValueError("no rows")
    if row["uneven"]:
        raise _uneven(width)
    return row["n"], np.frombuffer(row["mean"]), np.frombuffer(row["spread"]).reshape(shape)


def _matrix_moments(df: DataFrame, features: str, width: int) -> Moments:
    """As above for many columns, in one pass that checks the rows, too.

    Each task adds up outer products of blocks of centered rows; partial results are
    merged pairwise in a tree, so no task holds more than a few matrices.
    """
    count, mean, spread = _one_pass(df, features, width, squares=False)
    return Moments(count, mean, spread / count)


def _first_width(df: DataFrame, features: str) -> int:
    row = df.select(F.size(dense_array(df, features))).first()
    if row is None:
        raise ValueError("no rows")
    return row[0] or 0


def moments(df: DataFrame, features: str = "features", width: int | None = None) -> Moments:
    """Count, means and covariance; only d and d x d values reach the driver.

    A known ``width`` saves the look at a first row, which is not cheap behind a
    shuffle. Rows of another width, or with a NULL, are a ValueError.
    """
    if width is None:
        width = _first_width(df, features)
    if width < 1:
        raise _uneven(max(width, 1))
    if width <= _PAIRWISE_WIDTH:
        return _pairwise_moments(df, features, width)
    return _matrix_moments(df, features, width)


def column_means(df: DataFrame, features: str = "features") -> DataFrame:
    """Rows (i, mean) for the positions of a vector or array column."""
    mean = Summarizer.mean(as_vector(df, features))
    values = df.select(vector_to_array(mean).alias("mean"))
    return values.select(F.posexplode("mean").alias("i", "mean"))


def center(df: DataFrame, features: str = "features", output: str = "centered") -> DataFrame:
    """Add the array of each row's differences from the column means."""
    mean = df.select(vector_to_array(Summarizer.mean(as_vector(df, features)))).scalar()
    # A subquery may not stand inside an array function, so it gets a column first.
    difference = F.zip_with(dense_array(df, features), F.col("__mean"), lambda x, m: x - m)
    return df.withColumn("__mean", mean).withColumn(output, difference).drop("__mean")


def matrix_table(spark: SparkSession, matrix: np.ndarray, value: str) -> DataFrame:
    """A small driver matrix as rows (i, j, value)."""
    rows = [(i, j, float(x)) for (i, j), x in np.ndenumerate(matrix)]
    return spark.createDataFrame(rows, f"i int, j int, {value} double")


def covariance(
    df: DataFrame, features: str = "features", width: int | None = None
) -> DataFrame:
    """Covariance of all pairs of positions, divided by n, as rows (i, j, cov)."""
    return matrix_table(df.sparkSession, moments(df, features, width).covariance, "cov")


@dataclass(frozen=True)
class PrincipalComponents:
    """Top components as columns, all eigenvalues in falling order, and the scores."""

    components: np.ndarray
    eigenvalues: np.ndarray
    scores: DataFrame

    def variance_explained(self, k: int | None = None) -> float:
        """Share of the variance along the first ``k`` components."""
        k = self.components.shape[1] if k is None else k
        return float(self.eigenvalues[:k].sum() / self.eigenvalues.sum())


def _turned(loadings: np.ndarray) -> np.ndarray:
    """Signs that make the largest entry by magnitude of each column positive."""
    largest = np.abs(loadings).argmax(axis=0)
    return np.where(loadings[largest, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)


def _project(df: DataFrame, features: str, components: np.ndarray, output: str) -> DataFrame:
    values = dense_array(df, features)
    if components.size <= _WRITTEN_OUT:
        scores = F.array(*[dot(values, c.tolist()) for c in components.T])
    else:
        matrix = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in components.T])
        scores = F.transform(matrix, lambda c: dot(values, c))
    return df.withColumn(output, scores)


def pca(
    df: DataFrame,
    features: str = "features",
    k: int = 2,
    output: str = "scores",
    width: int | None = None,
) -> PrincipalComponents:
    """Components of the covariance, and the projections of the rows on them.

    Rows are projected as they are, not centered. Each component is turned so
    that its largest entry by magnitude is positive. All eigenvalues come from
    the same fit, so shares for any ``k`` need no further pass. Rows of another width,
    or with a NULL, are a ValueError.
    """
    if width is None:
        width = _first_width(df, features)
    if not 1 <= k <= width:
        raise ValueError(f"k must lie in 1..{width}")
    values, vectors = np.linalg.eigh(moments(df, features, width).covariance)
    vectors = vectors[:, ::-1]
    components = (vectors * _turned(vectors))[:, :k]
    scores = _project(df, features, components, output)
    return PrincipalComponents(components, np.maximum(values[::-1], 0.0), scores)


def variance_explained(df: DataFrame, features: str = "features", k: int = 1) -> float:
    """Share of the variance along the top ``k`` components."""
    return pca(df, features, k).variance_explained(k)


@dataclass(frozen=True)
class LeadingComponents:
    """Top components as columns, their eigenvalues, the total variance, and the scores."""

    components: np.ndarray
    eigenvalues: np.ndarray
    total: float
    scores: DataFrame

    def variance_explained(self, k: int | None = None) -> float:
        """Share of the variance along the first ``k`` components."""
        return float(self.eigenvalues[:k].sum() / self.total)


def _times_covariance(
    df: DataFrame, features: str, mean: np.ndarray, count: int, block: np.ndarray
) -> np.ndarray:
    """The covariance times the columns of ``block``, in one pass and without the covariance."""
    shared = df.sparkSession.sparkContext.broadcast((mean, block))

    def measure(batches):
        center, columns = shared.value
        total = np.zeros(columns.shape)
        for batch in batches:
            if batch.num_rows:
                rows = rows_of(batch.column(0), len(center)) - center
                total += rows.T @ (rows @ columns)
        yield pa.RecordBatch.from_pydict({"total": [total.tobytes()]})

    def merge(batches):
        total = np.zeros(shared.value[1].shape)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part).reshape(total.shape)
        yield pa.RecordBatch.from_pydict({"total": [total.tobytes()]})

    partial = df.select(dense_array(df, features).alias("v")).mapInArrow(measure, "total binary")
    row = _tree(partial, merge).first()
    shared.unpersist()
    return np.frombuffer(row["total"]).reshape(block.shape) / count


def _added(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the span of ``basis``."""
    for _ in range(2):  # once more, for what rounding left of the first time
        block = block - basis @ (basis.T @ block)
        left, sizes, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, sizes > 1e-12 * max(sizes.max(initial=0.0), 1e-300)]
    return block


def leading_components(
    df: DataFrame, features: str = "features", k: int = 2, output: str = "scores",
    width: int | None = None, block: int | None = None, tolerance: float = 1e-9,
    passes: int = 30, seed: int = 42,
) -> LeadingComponents:
    """The top ``k`` components of very wide rows, without the covariance matrix.

    Block Lanczos: each pass over the rows multiplies the covariance by a block of columns;
    the blocks' span holds ever better components, found there as in a small matrix. It
    ends when none of the ``k`` is off by more than ``tolerance`` times the top eigenvalue
    (or the span is everything); short of that after ``passes``, it is an error. The driver
    holds width x (block x passes) numbers at most. Scores and signs are as for ``pca``.
    """
    if width is None:
        width = _first_width(df, features)
    if not 1 <= k <= width:
        raise ValueError(f"k must lie in 1..{width}")
    count, mean, spread = _one_pass(df, features, width, squares=True)
    size = min(width, block or max(32, 2 * k))
    start = np.random.default_rng(seed).standard_normal((width, size))
    basis = np.zeros((width, 0))
    image = np.zeros((width, 0))
    fresh = _added(basis, start)
    for _ in range(passes):
        new = _times_covariance(df, features, mean, count, fresh)
        basis, image = np.hstack([basis, fresh]), np.hstack([image, new])
        small = basis.T @ image
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        top = vectors[:, :k]
        off = np.linalg.norm(image @ top - basis @ top * values[:k], axis=0)
        whole = basis.shape[1] == width
        done = basis.shape[1] >= k and off.max() <= tolerance * max(values[0], 1e-300)
        fresh = _added(basis, new)
        if done or whole or (not fresh.shape[1] and basis.shape[1] >= k):
            break
        if not fresh.shape[1]:  # rows of lower rank than k: any other directions will do
            fresh = _added(basis, np.random.default_rng(seed + 1).standard_normal((width, size)))
        fresh = fresh[:, : width - basis.shape[1]]
    else:
        raise ValueError(f"components still off by {off.max()} after {passes} passes")
    components = basis @ top
    components = components * _turned(components)
    scores = _project_wide(df, features, components, output)
    return LeadingComponents(components, np.maximum(values[:k], 0.0), float(spread.sum() / count), scores)


def _project_wide(df: DataFrame, features: str, components: np.ndarray, output: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(components)
    kept = [f for f in df.schema.fields if f.name != output]
    schema = T.StructType([*kept, T.StructField(output, T.ArrayType(T.DoubleType()))])

    def project(batches):
        columns = shared.value
        for batch in batches:
            rows = batch.column(batch.num_columns - 1)
            scores = rows_of(rows, len(columns)) @ columns if batch.num_rows else np.zeros((0, columns.shape[1]))
            ends = np.arange(len(rows) + 1, dtype=np.int32) * columns.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], schema.names)

    columns = [F.col(f.name) for f in kept]
    return df.select(*columns, dense_array(df, features).alias("__rows")).mapInArrow(project, schema)
