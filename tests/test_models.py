import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fieldloom.operators.evaluate import (
    add_baseline,
    add_log_loss,
    compare_models,
    evaluate_results,
    rmse,
)
from fieldloom.operators.expand import polynomial, two_way_interactions
from fieldloom.operators.linear import (
    apply_model,
    coefficient_table,
    fit_interactions,
    fit_linear,
    fit_polynomial_pipeline,
    gradient_summand,
    grid_search,
    linear_prediction,
    linreg_gradient_descent,
    vector_sum,
)
from fieldloom.operators.logistic import add_probability, fit_logistic, fit_logistic_hashed

POINTS = "label double, features array<double>"


def points(spark, n=400, d=3, noise=0.1, seed=5):
    draw = np.random.default_rng(seed)
    x = draw.random((n, d))
    y = x @ np.arange(1, d + 1) + 0.5 + noise * draw.standard_normal(n)
    rows = [(float(label), row.tolist()) for label, row in zip(y, x)]
    return spark.createDataFrame(rows, POINTS), x, y


def test_gradient_summand(spark):
    df = spark.createDataFrame([(2.0, [3.0, 1.0, 4.0])], POINTS)
    assert gradient_summand(df, [1, 1, 1]).first().summand == [18.0, 6.0, 24.0]


@pytest.mark.parametrize("d", [2, 17, 64, 65])
@pytest.mark.parametrize("wrong", [1, -1, None])
def test_dot_of_uneven_rows_fails(spark, d, wrong):
    row = [1.0] * (d - 1) + [None] if wrong is None else [1.0] * (d + wrong)
    df = spark.createDataFrame([(1.0, row)], POINTS)
    with pytest.raises(Exception, match="numbers"):
        linear_prediction(df, [1.0] * d).collect()


def test_descent_on_uneven_rows_fails(spark):
    df = spark.createDataFrame([(1.0, [1.0, 2.0]), (2.0, [1.0, 2.0, 3.0])], POINTS)
    with pytest.raises(ValueError):
        linreg_gradient_descent(df, 3)
    with pytest.raises(ValueError):
        linreg_gradient_descent(df.limit(1), 3, width=1)


def test_interactions_of_another_width_fail(spark):
    df = spark.createDataFrame([(1.0, [1.0, 2.0])], POINTS)
    with pytest.raises(Exception, match="numbers"):
        two_way_interactions(df, width=1).collect()


def test_vector_sum(spark):
    df = spark.createDataFrame([(2.0, [3.0, 1.0]), (1.0, [1.0, 1.0])], POINTS)
    summands = gradient_summand(df, [1.0, 0.0])
    assert [tuple(row) for row in vector_sum(summands).collect()] == [(0, 3.0), (1, 1.0)]


def test_linear_prediction(spark):
    df = spark.createDataFrame([(2.0, [1.0, 0.5]), (1.5, [0.5, 0.5])], POINTS)
    found = [tuple(row) for row in linear_prediction(df, [1.0, 1.5]).collect()]
    assert found == [(1.75, 2.0), (1.25, 1.5)]


@pytest.mark.parametrize("d", [1, 3, 12, 20])
def test_gradient_descent_against_numpy(spark, d):
    df, x, y = points(spark, d=d)
    w, errors = np.zeros(d), []
    for i in range(30):
        errors.append(np.sqrt(np.mean((x @ w - y) ** 2)))
        w = w - ((x @ w - y) @ x) / (len(y) * np.sqrt(i + 1))
    found = linreg_gradient_descent(df, 30)
    assert np.allclose(found.weights, w, rtol=1e-9)
    assert np.allclose(found.errors, errors, rtol=1e-9)


def test_gradient_descent_takes_vectors(spark):
    df, _, _ = points(spark)
    as_arrays = linreg_gradient_descent(df, 5)
    rows = [(row.label, Vectors.dense(row.features)) for row in df.collect()]
    as_vectors = linreg_gradient_descent(spark.createDataFrame(rows, ["label", "features"]), 5)
    assert np.allclose(as_arrays.weights, as_vectors.weights, rtol=1e-12)


def test_grid_search_keeps_best_and_earlier_on_ties(spark):
    df, x, y = points(spark)
    train, validation = df.limit(300), df.limit(100)
    result = grid_search(train, validation)
    assert [reg for reg, _ in result.trials] == [0.1, 1e-10, 1e-5, 1e-2, 1.0]
    assert result.best_rmse == min(error for _, error in result.trials)
    for reg, error in result.trials:
        scored = apply_model(validation, fit_linear(train, regParam=reg))
        value = scored.agg(rmse(F.col("prediction"), F.col("label"))).first()[0]
        assert value == pytest.approx(error, rel=1e-9)
    tied = grid_search(train, validation, grid=[0.1, 0.1])
    assert tied.best_reg == 0.1 and tied.best_rmse == tied.trials[0][1]


@pytest.mark.parametrize("width", [None, 2])
def test_two_way_interactions(spark, width):
    df = spark.createDataFrame([(0.0, [2.0, 3.0])], POINTS)
    row = two_way_interactions(df, width=width).first()
    assert row.features == [2.0, 3.0, 4.0, 6.0, 6.0, 9.0]


def test_two_way_interactions_of_three(spark):
    df = spark.createDataFrame([(1.0, [1.0, 2.0, 3.0])], POINTS)
    expected = sorted([1, 2, 3, 1, 2, 3, 2, 4, 6, 3, 6, 9])
    assert sorted(two_way_interactions(df).first().features) == expected


def test_polynomial(spark):
    df = spark.createDataFrame([(0.0, [2.0, 3.0])], POINTS)
    assert polynomial(df).first().polyFeatures.toArray().tolist() == [2, 4, 3, 6, 9]


def test_interaction_and_pipeline_models_agree_on_their_span(spark):
    df, x, y = points(spark, n=600, d=2, noise=0.01)
    curved = df.withColumn("label", F.col("label") + F.get("features", F.lit(0)) ** 2)
    model = fit_interactions(curved, width=2, tol=1e-10)
    scored = apply_model(two_way_interactions(curved, width=2), model)
    direct = scored.agg(rmse(F.col("prediction"), F.col("label"))).first()[0]
    rows = [(row.label, Vectors.dense(row.features)) for row in curved.collect()]
    vectors = spark.createDataFrame(rows, ["label", "features"])
    staged = fit_polynomial_pipeline(vectors, tol=1e-10).transform(vectors)
    piped = staged.agg(rmse(F.col("prediction"), F.col("label"))).first()[0]
    assert direct == pytest.approx(piped, rel=1e-3)
    assert direct == pytest.approx(0.01, rel=0.2)


def test_coefficient_table(spark):
    df, _, _ = points(spark, noise=0.0)
    model = fit_linear(df, regParam=0.0)
    found = {row.idx: row.coefficient for row in coefficient_table(df, model).collect()}
    assert found == pytest.approx({-1: 0.5, 0: 1.0, 1: 2.0, 2: 3.0})


def test_log_loss_toy(spark):
    rows = [(0.5, 1), (0.5, 0), (0.99, 1), (0.99, 0), (0.01, 1), (0.01, 0), (1.0, 1), (0.0, 1), (1.0, 0)]
    df = spark.createDataFrame(rows, "p double, label long")
    found = [row.log_loss for row in add_log_loss(df).collect()]
    assert np.allclose(
        found,
        [0.6931471805599451, 0.6931471805599451, 0.010050335853501338, 4.60517018598808,
         4.605170185988081, 0.010050335853501338, 0.0, 36.841361487904734, 36.841361487904734],
    )


def test_evaluate_constant_baseline(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,)], "label double")
    assert evaluate_results(df, baseline=0.5).first().log_loss == pytest.approx(np.log(2))
    with pytest.raises(ValueError):
        evaluate_results(df)


def test_baseline_uses_training_mean(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "label double")
    df = spark.createDataFrame([(2.0,), (4.0,)], "label double")
    scored = add_baseline(df, train)
    assert [row.prediction for row in scored.collect()] == [2.0, 2.0]
    value = scored.agg(rmse(F.col("prediction"), F.col("label"))).first()[0]
    assert value == pytest.approx(np.sqrt(2.0))


def binary(spark):
    rows = [(float(i % 3 == 0), [float(i % 2), float(i % 5)]) for i in range(200)]
    return spark.createDataFrame(rows, POINTS)


def test_probability_matches_model(spark):
    df = binary(spark)
    for model in (fit_logistic(df), fit_logistic_hashed(df)):
        for row in add_probability(df, model).collect():
            raw = np.dot(model.coefficients.toArray(), row.features) + model.intercept
            assert row.p == pytest.approx(1 / (1 + np.exp(-raw)), rel=1e-12)


def test_probability_is_clamped(spark):
    df = binary(spark)
    model = fit_logistic(df)
    far = spark.createDataFrame([(0.0, [1e9, 0.0]), (0.0, [-1e9, 0.0])], POINTS)
    low, high = 1 / (1 + np.exp(20)), 1 / (1 + np.exp(-20))
    found = sorted(row.p for row in add_probability(far, model).collect())
    assert found == pytest.approx([low, high], rel=1e-12)


def test_model_loss_is_mean_of_row_losses(spark):
    df = binary(spark)
    model = fit_logistic(df)
    rows = add_log_loss(add_probability(df, model)).collect()
    expected = np.mean([row.log_loss for row in rows])
    assert evaluate_results(df, model).first().log_loss == pytest.approx(expected)


def test_compare_models(spark):
    rows = [("train", 1.0, 1.0, 2.0), ("train", 2.0, 2.0, 2.0), ("test", 5.0, 4.0, 5.0)]
    df = spark.createDataFrame(rows, "split string, label double, a double, b double")
    table = compare_models(df, {"first": "a", "second": "b"}, "rmse")
    assert table.columns == ["model", "split", "metric", "value"]
    found = {(r.model, r.split, r.metric): r.value for r in table.collect()}
    assert found == pytest.approx({
        ("first", "train", "rmse"): 0.0, ("first", "test", "rmse"): 1.0,
        ("second", "train", "rmse"): np.sqrt(0.5), ("second", "test", "rmse"): 0.0,
    })
