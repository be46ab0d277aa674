"""Blocks of rows as matrices, and moments of blocks, for code that runs inside tasks.

Apart from the operators, so that a worker loads nothing else for it.
"""

import numpy as np
import pyarrow as pa


def rows_of(column: pa.Array, width: int) -> np.ndarray | None:
    """The rows of a list column as a matrix; None if one is NULL, uneven or has a NULL."""
    if column.null_count or len(column.flatten()) != len(column) * width:
        return None
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten()
    if values.null_count or (lengths != width).any():
        return None
    return values.to_numpy().reshape(len(column), width)


def merged(one, other):
    """Moments of the rows of two parts, from (n, uneven, mean, spread) of each.

    ``spread`` is the sum of the outer products (of the squares, if it is a vector) of
    centered rows. Means are moved, never sums of raw products taken apart, so no digits
    are lost, however small the deviations.
    """
    n = one[0] + other[0]
    uneven = one[1] or other[1]
    if not one[0] or not other[0]:
        full = one if one[0] else other
        return n, uneven, full[2], full[3]
    gap = other[2] - one[2]
    product = gap * gap if one[3].ndim == 1 else np.outer(gap, gap)
    mean = one[2] + gap * (other[0] / n)
    return n, uneven, mean, one[3] + other[3] + product * (one[0] * other[0] / n)
