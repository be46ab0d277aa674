"""Errors of predictions and comparison tables."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import label_loss
from .logistic import add_probability


def rmse(prediction: Column, label: Column) -> Column:
    """Root mean squared error as an aggregate, usable under any grouping."""
    difference = prediction - label
    return F.sqrt(F.avg(difference * difference))


def mean_log_loss(p: Column, label: Column) -> Column:
    """Mean log loss as an aggregate, usable under any grouping."""
    return F.avg(label_loss(p, label))


METRICS = {"rmse": rmse, "log_loss": mean_log_loss}


def add_log_loss(
    df: DataFrame, p: str = "p", label: str = "label", output: str = "log_loss"
) -> DataFrame:
    return df.withColumn(output, label_loss(F.col(p), F.col(label)))


def add_baseline(
    df: DataFrame, train: DataFrame, label: str = "label", output: str = "prediction"
) -> DataFrame:
    """The mean label of ``train`` as the prediction for every row of ``df``."""
    return df.withColumn(output, train.agg(F.avg(label)).scalar())


def evaluate_results(
    df: DataFrame, model=None, baseline: float | Column | None = None, label: str = "label"
) -> DataFrame:
    """One row with the mean ``log_loss`` of a model, or of a fixed probability."""
    if (model is None) == (baseline is None):
        raise ValueError("give either a model or a baseline")
    if model is not None:
        scored = add_probability(df, model)
    else:
        scored = df.withColumn("p", baseline if isinstance(baseline, Column) else F.lit(baseline))
    return scored.agg(mean_log_loss(F.col("p"), F.col(label)).alias("log_loss"))


def compare_models(
    df: DataFrame,
    predictions: Mapping[str, str],
    metric: str,
    label: str = "label",
    split: str = "split",
) -> DataFrame:
    """Rows (model, split, metric, value) for models scored side by side.

    ``predictions`` maps a model's name to its column. All models and parts are
    measured in one pass and one grouped aggregate.
    """
    measure = METRICS[metric]
    wide = df.groupBy(split).agg(
        *[
            measure(F.col(column), F.col(label)).alias(model)
            for model, column in predictions.items()
        ]
    )
    long = wide.unpivot([split], list(predictions), "model", "value")
    return long.select("model", split, F.lit(metric).alias("metric"), "value")
