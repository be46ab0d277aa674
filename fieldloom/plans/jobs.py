"""Whole jobs on text files: word counts, regression, click prediction, components.

Run one with ``python -m fieldloom.plans.jobs JOB FILE``.
"""

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import dot
from ..functions.vectors import as_vector
from ..operators.encode import build_dictionary, hash_features, one_hot_encode
from ..operators.evaluate import add_baseline, compare_models
from ..operators.expand import two_way_interactions
from ..operators.linear import (
    apply_model,
    fit_interactions,
    fit_polynomial_pipeline,
    grid_search,
    linreg_gradient_descent,
)
from ..operators.logistic import add_probability, fit_logistic, fit_logistic_hashed
from ..operators.parse import parse_categorical, parse_numeric_points, shift_label
from ..operators.pca import pca
from ..operators.split import with_split
from ..operators.tokens import word_count
from ..sources import read_lines
from ..storage import materialize, released

_ITERATIONS = 50
# Copies of a line that are numbered in one row.
_RUN = 4096


def _train(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")


def _numbered(lines: DataFrame, parse: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Parsed and written lines with a number each, and their part of the split.

    Lines carry no key, and their place depends on how files are cut. The part follows
    from the line itself and a number among its equals, so the same lines always give
    the same parts, and equal lines still spread over all of them.

    Copies are counted for each part of the input; the counts of the parts before give the
    first number. Copies of a line that has many are numbered in runs, dealt out to all
    tasks, so no row or task holds all of them.
    """
    spark = lines.sparkSession
    counted = lines.groupBy("value", F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted, f"{name}-copies")
    same = W.partitionBy("value")
    before = F.sum("n").over(same.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    counted = counted.select(
        "value", "n", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(same).alias("copies")
    )
    runs = counted.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(_RUN)))).select(
        "value",
        "copies",
        (F.col("before") + F.col("at") + 1).alias("first"),
        (F.col("before") + F.least(F.col("at") + _RUN, F.col("n"))).alias("last"),
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.filter(F.col("copies") > _RUN).repartition(tasks, "value", "first")
    keyed = runs.filter(F.col("copies") <= _RUN).unionByName(dealt).select(
        "value",
        F.col("value").alias("__line"),
        F.explode(F.sequence("first", "last")).alias("__copy"),
    )
    parsed = with_split(parse(keyed), ["__line", "__copy"]).drop("__line", "__copy")
    return materialize(parsed.withColumn("row", F.monotonically_increasing_id()), name)


def words(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """The most frequent words of a text file."""
    return word_count(read_lines(spark, path), k=k)


def regression(spark: SparkSession, path: str) -> DataFrame:
    """RMSE by model and split for lines ``label,x0,x1,...``.

    The models are the mean label, gradient descent, elastic net, the best of a
    grid, all two-way interactions, and a pipeline of polynomial expansion and
    regression.
    """
    points = _numbered(read_lines(spark, path), parse_numeric_points, "points")
    points = shift_label(points)
    train = _train(points)
    width = len(points.select("features").first()["features"])

    descent = linreg_gradient_descent(train, _ITERATIONS)
    grid = grid_search(train, points.filter(F.col("split") == "validation"))
    interactions = fit_interactions(train, width=width)
    vectors = points.withColumn("features", as_vector(points, "features"))
    pipeline = fit_polynomial_pipeline(_train(vectors))

    scored = add_baseline(points, train, output="baseline")
    scored = scored.withColumn("descent", dot(F.col("features"), descent.weights))
    scored = apply_model(scored, grid.models[0], output="elastic_net")
    scored = apply_model(scored, grid.best_model, output="grid")
    scored = two_way_interactions(scored, output="products", width=width)
    scored = apply_model(scored, interactions, "products", "interactions").drop("products")
    scored = scored.withColumn("features", as_vector(scored, "features"))
    scored = pipeline.transform(scored).withColumnRenamed("prediction", "pipeline")
    models = ["baseline", "descent", "elastic_net", "grid", "interactions", "pipeline"]
    return compare_models(scored, {name: name for name in models}, "rmse")


def clicks(spark: SparkSession, path: str) -> DataFrame:
    """Log loss by model and split for tab-separated lines of a 0/1 label and categories.

    The models are the class fraction (of the training rows; for test rows their own),
    and logistic models on one-hot and on hashed features.
    """
    rows = _numbered(read_lines(spark, path), parse_categorical, "clicks")
    train = _train(rows)

    kept = ["row", "split", "label", "feature"]
    one_hot = one_hot_encode(
        rows, build_dictionary(train), row_id="row", keep=kept, written=True
    )
    one_hot_model = fit_logistic(_train(one_hot))
    scored = add_probability(one_hot, one_hot_model, output="one_hot").drop("features")
    hashed = hash_features(scored, keep=["split", "label", "one_hot"], written=True)
    hashed_model = fit_logistic_hashed(_train(hashed))
    scored = add_probability(hashed, hashed_model, output="hashed").drop("features")
    # Test rows are held against their own class fraction, the others against that of
    # the training rows.
    own = rows.filter(F.col("split") == "test").selectExpr("mean(label)").scalar()
    scored = add_baseline(scored, train, output="baseline")
    scored = scored.withColumn("baseline", F.when(F.col("split") == "test", own).otherwise(F.col("baseline")))
    models = ["baseline", "one_hot", "hashed"]
    return compare_models(scored, {name: name for name in models}, "log_loss")


def components(spark: SparkSession, path: str, k: int = 2) -> DataFrame:
    """Rows (component, eigenvalue, share, loadings) for lines ``x0,x1,...``.

    The share is that of the variance along the components up to this one.
    """
    numbers = F.transform(F.split("value", ","), lambda x: x.cast("double"))
    points = materialize(read_lines(spark, path).select(numbers.alias("features")), "points")
    found = pca(points, k=min(k, len(points.first()["features"])))
    rows = [
        (i, float(value), found.variance_explained(i + 1), found.components[:, i].tolist())
        for i, value in enumerate(found.eigenvalues[: found.components.shape[1]])
    ]
    shape = "component int, eigenvalue double, share double, loadings array<double>"
    return spark.createDataFrame(rows, shape)


JOBS = {"words": words, "regression": regression, "clicks": clicks, "components": components}


if __name__ == "__main__":
    if len(sys.argv) != 3 or sys.argv[1] not in JOBS:
        sys.exit(f"usage: jobs {{{','.join(JOBS)}}} FILE")
    session = SparkSession.builder.appName(sys.argv[1]).getOrCreate()
    with released(session):
        JOBS[sys.argv[1]](session, sys.argv[2]).show(1000, truncate=False)
    session.stop()
