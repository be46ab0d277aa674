"""Feature interactions."""

from pyspark.ml.feature import PolynomialExpansion
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import checked
from ..functions.vectors import as_vector, dense_array


def two_way_products(features: Column, width: int | None = None) -> Column:
    """The features followed by all ordered products of two of them.

    Both x*y and y*x appear. A known ``width`` gives plain products in generated
    code in place of nested array functions, and takes rows to have that width.
    """
    if width is None:
        products = F.flatten(
            F.transform(features, lambda x: F.transform(features, lambda y: x * y))
        )
    else:
        items = [F.get(features, F.lit(i)) for i in range(width)]
        products = F.array(*[x * y for x in items for y in items])
    return F.concat(features, products)


def two_way_interactions(
    df: DataFrame,
    features: str = "features",
    output: str | None = None,
    width: int | None = None,
) -> DataFrame:
    """Replace (or add as ``output``) an array column by its two-way interactions.

    With a known ``width``, rows of another width, or with a NULL entry, fail the job.
    """
    if width is None:
        return df.withColumn(output or features, two_way_products(dense_array(df, features)))
    # The array has a column of its own, so that it is worked out and checked once a row,
    # not in every product.
    return (
        df.withColumn("__once", checked(dense_array(df, features), width))
        .withColumn(output or features, two_way_products(F.col("__once"), width))
        .drop("__once")
    )


def polynomial(
    df: DataFrame, features: str = "features", output: str = "polyFeatures", degree: int = 2
) -> DataFrame:
    """Products up to ``degree`` without duplicates, as a vector column."""
    prepared = df.withColumn("__vector", as_vector(df, features))
    stage = PolynomialExpansion(degree=degree, inputCol="__vector", outputCol=output)
    return stage.transform(prepared).drop("__vector")
