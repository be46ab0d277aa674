"""Logistic models."""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clamped_sigmoid
from ..functions.vectors import as_vector, stored_entries
from .keyed import fit_by_key

# The settings used on one-hot and on hashed features.
ONE_HOT_SETTINGS = {"elasticNetParam": 0.0, "regParam": 0.01, "maxIter": 20}
HASHED_SETTINGS = {"elasticNetParam": 0.7, "regParam": 0.001, "maxIter": 20}

# Models of more coefficients than this are fitted by key if their rows allow it. Below it, a
# gradient of each partition is small, however many steps there are.
WIDE = 2**16
_BY_KEY = {"elasticNetParam", "regParam", "maxIter", "tol", "standardization"}


def _fit_by_key(rows: DataFrame, settings: dict, wide: int) -> LogisticRegressionModel | None:
    """The model fitted by ``fit_by_key``, or None if settings or rows are not for that."""
    estimator = LogisticRegression(**settings)
    penalty = estimator.getRegParam()
    if not _BY_KEY.issuperset(settings) or estimator.getStandardization():
        return None
    if estimator.getElasticNetParam() or not penalty:
        return None
    first = rows.select(F.unwrap_udt("features")["size"].alias("size")).first()
    if first is None or (first["size"] or 0) <= wide:
        return None
    found = fit_by_key(rows, penalty, estimator.getMaxIter(), estimator.getTol())
    if found is None:
        return None
    spark = rows.sparkSession
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    weights = _py2java(spark.sparkContext, Vectors.dense(found[1]))
    model = LogisticRegressionModel(java(estimator.uid, weights, found[0]))
    for name, value in settings.items():
        model.set(model.getParam(name), value)
    return model


def fit_logistic(
    train: DataFrame, features: str = "features", label: str = "label", wide: int = WIDE, **settings
) -> LogisticRegressionModel:
    """Fit without feature scaling, by the one-hot settings unless overridden.

    Each step of Spark's solver shuffles a gradient over all coefficients for each
    partition. A model of more than ``wide`` coefficients without L1 penalty, whose rows
    have one wide index each, is fitted by key in place of that (see ``fit_by_key``).
    """
    chosen = {"standardization": False, **ONE_HOT_SETTINGS, **settings}
    rows = train.select(as_vector(train, features).alias("features"), F.col(label).alias("label"))
    # Arrays become dense vectors, in which no index is a row's own.
    sparse = isinstance(train.schema[features].dataType, VectorUDT)
    model = _fit_by_key(rows, chosen, wide) if sparse else None
    return model or LogisticRegression(**chosen).fit(rows)


def fit_logistic_hashed(
    train: DataFrame, features: str = "features", label: str = "label", **settings
) -> LogisticRegressionModel:
    """Fit by the elastic-net settings used on hashed features."""
    return fit_logistic(train, features, label, **{**HASHED_SETTINGS, **settings})


def add_probability(
    df: DataFrame, model: LogisticRegressionModel, features: str = "features", output: str = "p"
) -> DataFrame:
    """Add the probability of class 1, from a raw prediction bounded to -20..20."""
    scorer = model.copy()
    scorer.setFeaturesCol("__vector").setRawPredictionCol("__raw")
    scorer.setProbabilityCol("").setPredictionCol("")
    scored = scorer.transform(df.withColumn("__vector", as_vector(df, features)))
    raw = F.get(vector_to_array(F.col("__raw")), F.lit(1))
    return scored.withColumn(output, clamped_sigmoid(raw)).drop("__vector", "__raw")


def optimality(
    df: DataFrame, model: LogisticRegressionModel, features: str = "features", label: str = "label"
) -> DataFrame:
    """How far each coefficient is from meeting the conditions of the optimum on ``df``.

    Rows (idx, n_rows, excess) for every index of the model, the intercept at -1: in how
    many rows the index is stored, and the size of the slope of the penalized mean log loss
    there, divided by the share of these rows. So a coefficient counts by the rows that it
    works on, however many others there are, and an altered rare one shows. At coefficient
    0 the L1 part allows any slope up to its weight. An index without rows has the slope of
    the penalty alone. Sums are combined before the one shuffle; the model's penalties are
    read off the model, which has to be fitted without standardization.
    """
    reg, mixing = model.getRegParam(), model.getElasticNetParam()
    scored = add_probability(df, model, features, "__p")
    residual = F.col("__p") - F.col(label)
    entries = F.concat(
        F.array(F.struct(F.lit(-1).alias("indices"), F.lit(1.0).alias("values"))),
        stored_entries(as_vector(scored, features)),
    )
    sums = (
        scored.select(residual.alias("residual"), F.explode_outer(entries).alias("entry"))
        .groupBy(F.col("entry")["indices"].alias("idx"))
        .agg(
            F.sum(F.col("residual") * F.col("entry")["values"]).alias("total"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    rows = df.agg(F.count(F.lit(1))).scalar()
    coefficients = np.concatenate([[model.intercept], model.coefficients.toArray()])
    table = df.sparkSession.createDataFrame(
        pa.table({"idx": pa.array(np.arange(-1, len(coefficients) - 1), pa.int32()), "weight": coefficients})
    )
    # Every index has to be there, with rows or without.
    joined = sums.join(table, "idx", "full_outer").withColumn("rows", rows)
    n_rows = F.coalesce("n_rows", F.lit(0))
    slope = F.coalesce("total", F.lit(0.0)) / F.col("rows")
    weight = F.when(F.col("idx") >= 0, F.col("weight")).otherwise(0.0)
    free = F.col("idx") < 0
    smooth = slope + reg * (1 - mixing) * weight + reg * mixing * F.signum(weight)
    allowed = F.when(free, F.lit(0.0)).otherwise(F.lit(reg * mixing))
    excess = F.when(weight != 0, F.abs(smooth)).otherwise(F.greatest(F.abs(slope) - allowed, F.lit(0.0)))
    share = F.when(n_rows > 0, n_rows / F.col("rows")).otherwise(1.0)
    return joined.select(
        F.col("idx").cast("bigint").alias("idx"), n_rows.alias("n_rows"), (excess / share).alias("excess")
    )
