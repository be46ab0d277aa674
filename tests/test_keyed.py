"""Logistic fits of rows with one wide index each."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fieldloom.functions.vectors import stored_vector
from fieldloom.operators.keyed import MAX_SHARED, fit_by_key
from fieldloom.operators.logistic import fit_logistic, optimality
from fieldloom.storage import materialize_vectors


def keyed_rows(spark, n=1500, keys=240):
    """Three shared indices, then keys; the first key is in a fifth of the rows, some rows
    have none, and values differ."""
    draw = np.random.default_rng(5)
    rows = []
    for i in range(n):
        entries = {int(draw.integers(3)): float(draw.choice([1.0, -2.0, 0.5]))}
        if i % 7:
            entries[3 + (0 if draw.random() < 0.2 else int(draw.integers(keys)))] = float(draw.choice([1.0, 3.0]))
        chance = 0.2 + 0.5 * (max(entries) % 2)
        rows.append((float(draw.random() < chance), Vectors.sparse(3 + keys + 2, entries)))
    rows += rows[:200]
    return spark.createDataFrame(rows, ["label", "features"]).repartition(5)


@pytest.mark.parametrize("penalty", [0.01, 1e-4])
@pytest.mark.parametrize("batch", [10000, 7])
def test_agrees_with_the_solver(spark, penalty, batch):
    df = keyed_rows(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, batch)
    try:
        intercept, weights = fit_by_key(df, penalty, 100, 1e-14)
    finally:
        spark.conf.unset(name)
    expected = LogisticRegression(standardization=False, regParam=penalty, maxIter=1000, tol=1e-14).fit(df)
    assert intercept == pytest.approx(expected.intercept, abs=1e-5)
    assert weights == pytest.approx(expected.coefficients.toArray(), abs=1e-5)


def test_model_of_the_operator(spark):
    df = keyed_rows(spark)
    model = fit_logistic(df, wide=10, maxIter=100, tol=1e-14)
    assert model.getRegParam() == 0.01 and model.numFeatures == 245 and not model.hasSummary
    assert max(r.excess for r in optimality(df, model).collect()) < 1e-6


def test_keys_at_any_place_of_the_row(spark):
    """Where a field is missing, the key moves up among the entries."""
    draw = np.random.default_rng(6)
    rows = []
    for i in range(1200):
        names = [int(draw.integers(3))] if i % 10 else []
        names += [3 + int(draw.integers(4)) if i % 9 else 7 + int(draw.integers(4))]
        key = 11 + int(draw.integers(300)) + 300 * (i % 10 == 0)
        rows.append((float(draw.random() < 0.4), Vectors.sparse(611, {k: 1.0 for k in [*names, key]})))
    df = spark.createDataFrame(rows, ["label", "features"])
    model = fit_logistic(df, wide=10, maxIter=100, tol=1e-14)
    assert not model.hasSummary
    assert max(r.excess for r in optimality(df, model).collect()) < 1e-6


def test_other_rows_are_left_to_the_solver(spark):
    df = keyed_rows(spark, 300)
    assert fit_logistic(df, wide=10, elasticNetParam=0.5).hasSummary
    assert fit_logistic(df, wide=10, regParam=0.0).hasSummary
    assert fit_by_key(df.withColumn("label", F.col("label") + 1), 0.01, 10, 1e-6) is None
    assert fit_by_key(df.filter("label = 0"), 0.01, 10, 1e-6) is None
    two = spark.range(2 * MAX_SHARED).select(
        (F.col("id") % 2).cast("double").alias("label"),
        stored_vector(4 * MAX_SHARED, F.array("id", F.col("id") + 2 * MAX_SHARED), F.array(F.lit(1.0), F.lit(1.0))).alias("features"),
    )
    assert fit_by_key(materialize_vectors(two, "features", "two"), 0.01, 10, 1e-6) is None


@pytest.mark.parametrize("settings", [{"maxIter": 1000, "tol": 1e-15}, {"maxIter": 500, "tol": 1e-9}])
def test_a_wide_model_takes_few_steps(spark, settings):
    """Each step of the solver shuffles all coefficients from each partition."""
    width, n = 70000, 140000
    key = 4 + F.pmod(F.xxhash64("id"), F.lit(width - 4)).cast("int")
    rows = spark.range(0, n, 1, 8).select(
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) == 0).cast("double").alias("label"),
        stored_vector(width, F.array((F.col("id") % 4).cast("int"), key), F.array(F.lit(1.0), F.lit(1.0))).alias("features"),
    )
    df = materialize_vectors(rows, "features", "wide")
    spark.sparkContext.setJobGroup("wide-fit", "")
    try:
        model = fit_logistic(df, **settings)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("wide-fit")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 30
    assert max(r.excess for r in optimality(df, model).collect()) < 5e-4
