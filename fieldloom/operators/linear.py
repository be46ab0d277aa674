"""Linear regression."""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import dot
from ..functions.vectors import as_vector, dense_array, stored_entries
from .evaluate import rmse
from .expand import two_way_interactions
from .pca import Moments, moments

# The settings of the first elastic-net fit, of the grid around
# it, and of the fits on interactions.
ELASTIC_NET_SETTINGS = {
    "maxIter": 500, "regParam": 0.1, "elasticNetParam": 0.2, "fitIntercept": True,
}
GRID = (1e-10, 1e-5, 1e-2, 1.0)
INTERACTION_REG = 1e-10


def gradient_summand(
    df: DataFrame,
    weights: Sequence[float],
    features: str = "features",
    label: str = "label",
    output: str = "summand",
) -> DataFrame:
    """Add each row's part of the squared-error gradient, (w.x - y) x."""
    values = dense_array(df, features)
    residual = dot(values, weights) - F.col(label)
    return df.withColumn("__residual", residual).withColumn(
        output, F.transform(values, lambda x: F.col("__residual") * x)
    ).drop("__residual")


def linear_prediction(
    df: DataFrame,
    weights: Sequence[float],
    features: str = "features",
    label: str = "label",
) -> DataFrame:
    """Pairs (prediction, label) of a linear model without intercept."""
    return df.select(
        dot(dense_array(df, features), weights).alias("prediction"),
        F.col(label).cast("double").alias("label"),
    )


@dataclass(frozen=True)
class DescentResult:
    """Final weights, and the training RMSE before each step."""

    weights: list[float]
    errors: list[float]


def _joint_moments(df: DataFrame, features: str, label: str, width: int | None) -> Moments:
    """Moments of label and features; the label stands first, where no width can move it."""
    joined = df.select(
        F.concat(F.array(F.col(label).cast("double")), dense_array(df, features)).alias("z")
    )
    return moments(joined, "z", None if width is None else width + 1)


def linreg_gradient_descent(
    train: DataFrame,
    num_iters: int,
    features: str = "features",
    label: str = "label",
    width: int | None = None,
) -> DescentResult:
    """Batch gradient descent without intercept from zero weights, step 1/(n sqrt(i+1)).

    The gradient and the error of any weights follow from the second moments of
    features and label. One aggregate over the data yields those, and the
    iterations then work on d x d numbers: one pass for any number of steps. Rows of
    different widths, or with a NULL, are a ValueError.
    """
    stats = _joint_moments(train, features, label, width)
    mean_x, mean_y = stats.mean[1:], stats.mean[0]
    cov_xx, cov_xy = stats.covariance[1:, 1:], stats.covariance[1:, 0]
    var_y = stats.covariance[0, 0]
    square = cov_xx + np.outer(mean_x, mean_x)
    product = cov_xy + mean_x * mean_y
    weights = np.zeros(len(mean_x))
    errors = []
    for i in range(num_iters):
        # Variance of the residual plus its squared mean: centered terms lose
        # fewer digits than sums of raw squares.
        spread = weights @ cov_xx @ weights - 2 * weights @ cov_xy + var_y
        errors.append(float(np.sqrt(max(spread, 0.0) + (weights @ mean_x - mean_y) ** 2)))
        weights = weights - (square @ weights - product) / np.sqrt(i + 1)
    return DescentResult(weights.tolist(), errors)


def linreg_gradient_descent_sparse(
    train: DataFrame, num_iters: int, features: str = "features", label: str = "label"
) -> DescentResult:
    """The same descent on vectors of very many features, most of them zero.

    Nothing of the size of the square of the features is formed: every step is one
    aggregate over the stored entries, combined before it is shuffled, and brings one
    number per feature to the driver; weights go out by broadcast, inside a model. Rows
    are kept between steps.
    """
    spark = train.sparkSession
    rows = _labelled(train, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = rows.select(F.unwrap_udt("features")["size"], F.size(vector_to_array("features"))).first()
        if first is None:
            raise ValueError("no rows")
        weights = np.zeros(first[0] if first[0] is not None else first[1])
        errors = []
        for i in range(num_iters):
            scored = apply_model(rows, linear_model(spark, weights))
            residual = F.col("prediction") - F.col("label")
            # Position -1 holds the residual itself: its sum is that of the squares.
            entries = F.concat(
                F.array(F.struct(F.lit(-1).alias("indices"), residual.alias("values"))),
                stored_entries(F.col("features")),
            )
            sums = (
                scored.select(residual.alias("residual"), F.explode_outer(entries).alias("entry"))
                .groupBy(F.col("entry")["indices"].alias("i"))
                .agg(F.sum(F.col("residual") * F.col("entry")["values"]).alias("total"), F.count(F.lit(1)).alias("n"))
                .toArrow()
            )
            place, total, count = (sums.column(name).to_numpy() for name in ("i", "total", "n"))
            own = int(np.flatnonzero(place == -1)[0])
            errors.append(float(np.sqrt(total[own] / count[own])))
            gradient = np.zeros(len(weights))
            gradient[place[place >= 0]] = total[place >= 0]
            weights = weights - gradient / (count[own] * np.sqrt(i + 1))
    finally:
        rows.unpersist()
    return DescentResult(weights.tolist(), errors)


def vector_sum(df: DataFrame, features: str = "summand") -> DataFrame:
    """Rows (i, total): the sums of all positions of a vector or array column."""
    total = Summarizer.sum(as_vector(df, features))
    return df.select(vector_to_array(total).alias("total")).select(
        F.posexplode("total").alias("i", "total")
    )


def _labelled(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.select(as_vector(df, features).alias("features"), F.col(label).alias("label"))


def linear_model(
    spark: SparkSession, coefficients: Sequence[float], intercept: float = 0.0
) -> LinearRegressionModel:
    """A model of given coefficients, which scores like a fitted one."""
    values = _py2java(spark.sparkContext, DenseVector(np.asarray(coefficients, float)))
    uid = f"LinearRegressionModel_{uuid.uuid4().hex[:12]}"
    model = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel(uid, values, float(intercept))
    return LinearRegressionModel(model)


def fit_least_squares(
    train: DataFrame, features: str = "features", label: str = "label", width: int | None = None
) -> LinearRegressionModel:
    """Unpenalized regression from one pass of second moments.

    Columns may depend on each other: of all solutions of the normal equations this is the
    one with the least coefficients, as measured on columns of unit deviation. Constant
    columns get coefficient 0.
    """
    stats = _joint_moments(train, features, label, width)
    scale, correlation, with_label = _standardized(stats)
    values, vectors = np.linalg.eigh(correlation)
    used = values > len(values) * 1e-13 * max(values.max(initial=0.0), 1e-300)
    solved = vectors[:, used] @ ((vectors[:, used].T @ with_label) / values[used])
    return _scaled_model(train.sparkSession, stats, scale, solved)


def _standardized(stats: Moments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deviations (label first), and correlations of the features among each other and with
    the label; those of constant columns are 0."""
    scale = np.sqrt(np.diag(stats.covariance).clip(0))
    safe = np.where(scale > 0, scale, 1.0)
    whole = np.where(np.outer(scale, scale) > 0, stats.covariance / np.outer(safe, safe), 0.0)
    return scale, whole[1:, 1:], whole[1:, 0]


def _scaled_model(spark, stats: Moments, scale: np.ndarray, solved: np.ndarray) -> LinearRegressionModel:
    """The model of standardized coefficients, in the units of the data."""
    coefficients = np.where(scale[1:] > 0, solved * scale[0] / np.where(scale[1:] > 0, scale[1:], 1.0), 0.0)
    return linear_model(spark, coefficients, stats.mean[0] - coefficients @ stats.mean[1:])


def elastic_net(
    correlation: np.ndarray, with_label: np.ndarray, l1: float, l2: float, start: np.ndarray,
    rounds: int = 20_000, tolerance: float = 1e-13,
) -> np.ndarray:
    """The w with the least w'Rw / 2 - r'w + l1 |w| + l2 w'w / 2, by coordinate descent.

    Once signs settle, the equations of the nonzero coefficients are solved as they are;
    if that meets the conditions of the optimum, it ends the descent.
    """
    w = start.copy()
    slope = with_label - correlation @ w
    own = np.diag(correlation)
    for sweep in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(own > 0):
            pull = slope[j] + own[j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (own[j] + l2)
            step = new - w[j]
            if step:
                slope -= correlation[:, j] * step
                w[j] = new
                moved = max(moved, abs(step))
        if moved <= tolerance:
            break
        if sweep % 20 == 19:
            active = np.flatnonzero(w)
            left = correlation[np.ix_(active, active)] + l2 * np.eye(len(active))
            solved = np.linalg.lstsq(left, with_label[active] - l1 * np.sign(w[active]), rcond=None)[0]
            trial = np.zeros(len(w))
            trial[active] = solved
            rest = with_label - correlation @ trial - l2 * trial
            fits = np.abs(rest[active] - l1 * np.sign(w[active])).max(initial=0.0) <= 1e-12
            rest[active] = 0.0
            if fits and (np.sign(solved) == np.sign(w[active])).all() and np.abs(rest).max(initial=0.0) <= l1 + 1e-12:
                return trial
    return w


def regularization_path(
    train: DataFrame, regs: Sequence[float], features: str = "features", label: str = "label",
    width: int | None = None, elasticNetParam: float = ELASTIC_NET_SETTINGS["elasticNetParam"],
) -> list[LinearRegressionModel]:
    """Elastic nets for all of ``regs`` from one pass over the rows, in their order.

    Second moments are all that the fits need. They go from the largest penalty to the
    least, each from where the one before ended. Penalties count as in ``fit_linear``: on
    columns of unit deviation, in units of the label's deviation.
    """
    stats = _joint_moments(train, features, label, width)
    scale, correlation, with_label = _standardized(stats)
    models: list[LinearRegressionModel | None] = [None] * len(regs)
    w = np.zeros(len(with_label))
    for i in sorted(range(len(regs)), key=lambda i: -regs[i]):
        if scale[0] > 0:
            penalty = regs[i] / scale[0]
            w = elastic_net(correlation, with_label, penalty * elasticNetParam, penalty * (1 - elasticNetParam), w)
        models[i] = _scaled_model(train.sparkSession, stats, scale, w)
    return models


def fit_linear(
    train: DataFrame, features: str = "features", label: str = "label", **settings
) -> LinearRegressionModel:
    """Elastic-net regression, by the usual settings unless overridden."""
    estimator = LinearRegression(**{**ELASTIC_NET_SETTINGS, **settings})
    return estimator.fit(_labelled(train, features, label))


def apply_model(
    df: DataFrame, model: LinearRegressionModel, features: str = "features",
    output: str = "prediction",
) -> DataFrame:
    """Add the predictions of a fitted model."""
    scorer = model.copy()
    scorer.setFeaturesCol("__vector").setPredictionCol(output)
    return scorer.transform(df.withColumn("__vector", as_vector(df, features))).drop("__vector")


@dataclass(frozen=True)
class GridResult:
    """All (regParam, validation RMSE) and models in the order tried, and the best."""

    trials: list[tuple[float, float]]
    models: list[LinearRegressionModel]
    best_reg: float
    best_rmse: float
    best_model: LinearRegressionModel


def grid_search(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[float] = GRID,
    features: str = "features",
    label: str = "label",
    **settings,
) -> GridResult:
    """Fit the first model and one per grid value; keep the lowest validation RMSE.

    A later model replaces an earlier one only if strictly better. Training rows
    are kept between fits, and all models are measured in one pass.
    """
    first = {**ELASTIC_NET_SETTINGS, **settings}
    regs = [first["regParam"], *grid]
    rows = _labelled(train, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = [LinearRegression(**{**first, "regParam": reg}).fit(rows) for reg in regs]
    finally:
        rows.unpersist()
    return _chosen(regs, models, validation, features, label)


def path_search(
    train: DataFrame,
    validation: DataFrame,
    grid: Sequence[float] = GRID,
    features: str = "features",
    label: str = "label",
    width: int | None = None,
) -> GridResult:
    """As ``grid_search``, with all models from one pass over the training rows."""
    regs = [ELASTIC_NET_SETTINGS["regParam"], *grid]
    models = regularization_path(train, regs, features, label, width)
    return _chosen(regs, models, validation, features, label)


def _chosen(regs, models, validation: DataFrame, features: str, label: str) -> GridResult:
    """All models measured in one pass; the best, the earliest of equals."""
    scored = _labelled(validation, features, label)
    for i, model in enumerate(models):
        scored = apply_model(scored, model, output=f"p{i}")
    values = scored.agg(*[rmse(F.col(f"p{i}"), F.col("label")) for i in range(len(models))]).first()
    best = min(range(len(models)), key=lambda i: (values[i], i))
    return GridResult(list(zip(regs, values)), models, regs[best], values[best], models[best])


def fit_interactions(
    train: DataFrame, features: str = "features", label: str = "label",
    width: int | None = None, **settings,
) -> LinearRegressionModel:
    """Regression on the features and all their ordered two-way products.

    Every product of two features is there twice. Without ``settings`` the normal equations
    are solved with the least coefficients, equal ones for equal columns; with some, an
    elastic net with next to no penalty is fitted step by step.
    """
    products = two_way_interactions(train, features, width=width)
    if not settings:
        return fit_least_squares(products, features, label, None if width is None else width + width**2)
    return fit_linear(products, features, label, **{"regParam": INTERACTION_REG, **settings})


def fit_polynomial_pipeline(
    train: DataFrame, features: str = "features", label: str = "label", degree: int = 2, **settings
) -> PipelineModel:
    """Two stages, polynomial expansion and regression, fitted as one pipeline.

    ``features`` has to hold vectors, here and in the frames transformed later.
    """
    chosen = {**ELASTIC_NET_SETTINGS, "regParam": INTERACTION_REG, **settings}
    expansion = PolynomialExpansion(degree=degree, inputCol=features, outputCol="polyFeatures")
    regression = LinearRegression(featuresCol="polyFeatures", labelCol=label, **chosen)
    return Pipeline(stages=[expansion, regression]).fit(train)


def coefficient_table(df: DataFrame, model) -> DataFrame:
    """Coefficients of a fitted model as rows (idx, coefficient), the intercept at -1."""
    coefficients = model.coefficients.toArray()
    rows = pa.table({
        "idx": pa.array(np.arange(-1, len(coefficients)), pa.int32()),
        "coefficient": np.concatenate([[model.intercept], coefficients]),
    })
    return df.sparkSession.createDataFrame(rows)
