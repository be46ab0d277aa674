"""Scalar formulas as column expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bound on a raw prediction, and the value that stands in for
# a probability of exactly zero.
RAW_BOUND = 20.0
EPSILON = 1e-16


# Up to this length a fixed inner product is written out as one sum, which stays
# in generated code; a longer one would outgrow what the JVM compiles.
_UNROLLED = 64


def _or_error(value: Column, width: Column) -> Column:
    """``value``, or an error where it is NULL."""
    text = F.concat(F.lit("not an array of "), width.cast("string"), F.lit(" numbers"))
    return F.coalesce(value, F.raise_error(text).cast("double"))


def dot(features: Column, weights: Sequence[float] | Column) -> Column:
    """Inner product of an array column with fixed weights or another array.

    A row whose array is NULL, of another length or has a NULL entry fails the job,
    whatever the length.
    """
    if not isinstance(weights, Column):
        width = F.lit(len(weights))
        if len(weights) <= _UNROLLED:
            total = F.lit(0.0)
            for i, weight in enumerate(weights):
                total = total + F.get(features, F.lit(i)) * F.lit(float(weight))
            return _or_error(F.when(F.size(features) == width, total), width)
        weights = F.array(*[F.lit(float(weight)) for weight in weights])
    # The shorter array is filled up with NULL, and one NULL makes the sum NULL.
    products = F.zip_with(features, weights, lambda a, b: a * b)
    total = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    return _or_error(total, F.size(weights))


def checked(features: Column, width: int) -> Column:
    """An array of doubles as it is; a row that has not ``width`` numbers fails the job."""
    total = F.lit(0.0)
    for i in range(width):
        total = total + F.get(features, F.lit(i))
    good = (F.size(features) == width) & total.isNotNull()
    text = F.lit(f"not an array of {width} numbers")
    return F.when(good, features).otherwise(F.raise_error(text).cast("array<double>"))


def clamped_sigmoid(raw: Column) -> Column:
    """Logistic function of a raw prediction bounded to -20..20."""
    bounded = F.greatest(F.lit(-RAW_BOUND), F.least(F.lit(RAW_BOUND), raw))
    return 1.0 / (1.0 + F.exp(-bounded))


def label_loss(p: Column, label: Column) -> Column:
    """Log loss of one prediction; every label other than 1 counts as class 0."""
    likelihood = F.when(label == 1, p).otherwise(1.0 - p)
    return -F.log(F.when(likelihood == 0, EPSILON).otherwise(likelihood))
