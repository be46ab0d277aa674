"""Logistic models of rows with one wide index each, such as a key, fitted group by group."""

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..groups import Groups, whole_groups

# Most indices that groups may share, and the share of rows from which an index is shared.
MAX_SHARED = 256
_SHARED_ROWS = 1 / 128
# Rows without an index of their own go to so many groups.
_REST = 2**20


def _own_indices(shared: np.ndarray) -> Column:
    """The row's indices that are not shared."""
    known = F.array(*[F.lit(int(i)) for i in shared]).cast("array<int>")
    return F.array_except("indices", known)


def _shared_indices(rows: DataFrame, total: int) -> np.ndarray | None:
    """Frequent indices without which no row has more than one, or None.

    Those of very many rows if that is enough, else the ``MAX_SHARED`` most frequent ones.
    """
    counts = rows.select(F.explode("indices").alias("idx")).groupBy("idx").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "idx").limit(MAX_SHARED + 1).collect()
    hot = [row["idx"] for row in top if row["n"] > total * _SHARED_ROWS]
    if len(hot) > MAX_SHARED:
        return None
    for chosen in (hot, [row["idx"] for row in top[:MAX_SHARED]]):
        shared = np.array(sorted(chosen), dtype=np.int64)
        if (rows.agg(F.max(F.size(_own_indices(shared)))).first()[0] or 0) <= 1:
            return shared
    return None


def _key(shared: np.ndarray) -> Column:
    """The row's own index, or a negative number if all of its indices are shared."""
    rest = -1 - F.pmod(F.xxhash64("indices", "values"), F.lit(_REST)).cast("int")
    return F.coalesce(F.get(_own_indices(shared), F.lit(0)), rest)


def fit_by_key(
    rows: DataFrame, penalty: float, steps: int, tol: float
) -> tuple[float, np.ndarray] | None:
    """Intercept and coefficients at the least of the mean log loss plus ``penalty`` / 2 of
    the squared coefficients, or None if the rows (features, label) are not of the kind.

    A row may have one wide index, such as a key, next to a few indices that very many rows
    share. Rows are brought together by their own index, once. For given shared weights the
    coefficients of the keys are then independent of each other and are found inside the
    tasks, exactly. What is left is a Newton iteration over the shared weights, whose slopes
    and curvature take the keys' answer into account. A step sends a matrix over the shared
    indices from each task, however many keys there are, in place of a gradient over all of
    them. It ends when the step's gain is below ``tol`` of the loss, after that step.
    """
    stored = F.unwrap_udt("features")
    rows = rows.select(
        F.col("label").cast("double").alias("label"),
        stored["size"].alias("size"), stored["indices"].alias("indices"), stored["values"].alias("values"),
    )
    marks = {"ones": F.col("label") == 1, "zeros": F.col("label") == 0, "sparse": F.col("indices").isNotNull()}
    counts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.max("size").alias("size"),
        *[F.count_if(mark).alias(name) for name, mark in marks.items()],
    ).first()
    total = counts["n"]
    if counts["ones"] + counts["zeros"] != total or not counts["ones"] or not counts["zeros"]:
        return None
    if counts["sparse"] != total or counts["least"] != counts["size"]:
        return None
    shared = _shared_indices(rows, total)
    if shared is None:
        return None
    keyed = rows.select(_key(shared).alias("key"), "label", "indices", "values")
    grouped = keyed.repartition("key").sortWithinPartitions("key").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        start = np.zeros(len(shared) + 1)
        start[0] = np.log(counts["ones"] / counts["zeros"])
        weights = _newton(grouped, shared, start, total, penalty, steps, tol)
        coefficients = np.zeros(counts["size"])
        coefficients[shared] = weights[1:]
        own = _own_coefficients(grouped, shared, weights, total, penalty)
        coefficients[own["key"].to_numpy()] = own["value"].to_numpy()
    finally:
        grouped.unpersist()
    return float(weights[0]), coefficients


def _newton(grouped, shared, weights, total, penalty, steps, tol) -> np.ndarray:
    width = len(weights)
    ridge = np.append(0.0, np.full(width - 1, penalty))
    best = np.inf
    for _ in range(steps):
        sums = _moments(grouped, shared, weights, total, penalty)
        loss = sums[0] + (ridge * weights * weights).sum() / 2
        if not np.isfinite(loss):
            raise ValueError("features are not finite")
        if loss > best * (1 + 1e-12):
            # Too far: back half of the way.
            weights = (weights + before) / 2
            continue
        best, before = loss, weights
        slopes = sums[1 : width + 1] + ridge * weights
        step = np.linalg.solve(sums[width + 1 :].reshape(width, width) + np.diag(ridge), slopes)
        weights = weights - step
        if slopes @ step <= tol * loss:
            break
    return weights


def _moments(grouped, shared, weights, total, penalty) -> np.ndarray:
    def measure(batches):
        sums = 0.0
        for table in whole_groups(batches):
            sums = sums + Groups(table, shared).moments(weights, total, penalty)
        if np.ndim(sums):
            yield pa.RecordBatch.from_pydict({"sums": [sums.tobytes()]})

    parts = grouped.mapInArrow(measure, "sums binary").collect()
    return sum(np.frombuffer(row["sums"]) for row in parts)


def _own_coefficients(grouped, shared, weights, total, penalty) -> pa.Table:
    def solve(batches):
        for table in whole_groups(batches):
            groups = Groups(table, shared)
            own = groups.solve(weights, total, penalty)[0]
            mine = groups.keys >= 0
            yield pa.RecordBatch.from_pydict({"key": pa.array(groups.keys[mine], pa.int32()), "value": own[mine]})

    return grouped.mapInArrow(solve, "key int, value double").toArrow()
