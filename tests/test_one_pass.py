"""Moments in one pass, descent on sparse rows, penalty paths, conditions of an optimum."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from test_models import points

from fieldloom.operators import linear as lin
from fieldloom.operators import pca as ops
from fieldloom.operators.encode import build_dictionary, encoding_sparsity, hash_features, mean_sparsity, one_hot_encode
from fieldloom.operators.expand import two_way_interactions
from fieldloom.operators.logistic import fit_logistic, fit_logistic_hashed, optimality
from fieldloom.operators.parse import parse_numeric_points
from fieldloom.plans import jobs
from fieldloom.plans import linear as plans
from fieldloom.sources import read_lines

ROWS = "features array<double>"


def frame(spark, rows, parts):
    return spark.createDataFrame([(row.tolist(),) for row in rows], ROWS).repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 20])
@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1e-7, 1.0), (1e-7, 0.0), (1e3, -1e6)])
def test_moments_of_wide_rows(spark, parts, scale, shift):
    rows = np.random.default_rng(parts).standard_normal((300, 20)) * scale + shift
    rows[:, 3] = shift
    found = ops.moments(frame(spark, rows, parts))
    centered = rows - rows.mean(0)
    expected = centered.T @ centered / len(rows)
    assert found.count == 300
    assert np.allclose(found.mean, rows.mean(0), rtol=1e-12, atol=1e-12 * scale)
    assert np.allclose(found.covariance, expected, rtol=1e-7, atol=1e-7 * scale**2)


@pytest.mark.parametrize("bad", [None, [1.0] * 19, [1.0] * 21, [*[1.0] * 19, None], []])
def test_moments_of_uneven_wide_rows_fail(spark, bad):
    df = spark.createDataFrame([([1.0] * 20,), (bad,), ([2.0] * 20,)], ROWS).repartition(3)
    with pytest.raises(ValueError, match="numbers"):
        ops.moments(df, width=20)
    with pytest.raises(ValueError, match="no rows"):
        ops.moments(df.limit(0), width=20)


@pytest.mark.parametrize("n, d, k", [(400, 64, 3), (30, 100, 5), (200, 150, 1), (5, 40, 10)])
def test_leading_components(spark, n, d, k):
    draw = np.random.default_rng(d)
    rows = draw.standard_normal((n, d)) @ np.diag(np.linspace(1, 3, d)) + 5
    found = ops.leading_components(frame(spark, rows, 3), k=k, block=16)
    values, vectors = np.linalg.eigh(np.cov(rows.T, bias=True))
    assert np.allclose(found.eigenvalues, values[::-1][:k].clip(0), rtol=1e-7, atol=1e-9)
    assert found.total == pytest.approx(values.sum(), rel=1e-9)
    strong = [i for i in range(k) if values[::-1][i] > 1e-9]
    same = np.abs(np.sum(vectors[:, ::-1][:, :k] * found.components, axis=0))
    assert np.allclose(same[strong], 1.0, atol=1e-6)
    scores = {tuple(r.features): r.scores for r in found.scores.collect()}
    assert np.allclose([scores[tuple(row)] for row in rows], rows @ found.components)


def test_leading_components_of_very_wide_rows(spark):
    draw = np.random.default_rng(1)
    left, right = draw.standard_normal((60, 3)) * [50, 20, 8], draw.standard_normal((3, 20_000))
    rows = left @ right + draw.standard_normal((60, 20_000))
    found = ops.leading_components(frame(spark, rows, 4), k=2, width=20_000)
    centered = rows - rows.mean(0)
    small = np.linalg.eigvalsh(centered @ centered.T / 60)[::-1]
    assert np.allclose(found.eigenvalues, small[:2], rtol=1e-8)


def sparse_points(spark, n=300, d=20, seed=1):
    draw = np.random.default_rng(seed)
    x = np.where(draw.random((n, d)) < 0.2, draw.random((n, d)), 0.0)
    y = x @ draw.random(d) + 1
    rows = [(float(b), Vectors.sparse(d, [(int(j), float(a[j])) for j in np.flatnonzero(a)])) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, ["label", "features"])


def test_sparse_descent_is_that_from_moments(spark):
    df = sparse_points(spark)
    wide, sparse = lin.linreg_gradient_descent(df, 6), lin.linreg_gradient_descent_sparse(df, 6)
    assert np.allclose(wide.weights, sparse.weights, rtol=1e-9, atol=1e-12)
    assert np.allclose(wide.errors, sparse.errors, rtol=1e-9)
    dense = df.withColumn("features", lin.dense_array(df, "features"))
    assert np.allclose(lin.linreg_gradient_descent_sparse(dense, 6).weights, wide.weights)


def test_sparse_descent_on_many_features(spark):
    d = 32_768
    rows = [(float(i % 3), Vectors.sparse(d, {i * 97 % d: 1.0, i * 31 % d: 2.0})) for i in range(1, 500)]
    df = spark.createDataFrame(rows, ["label", "features"])
    found = lin.linreg_gradient_descent_sparse(df, 4)
    x = np.array([r[1].toArray() for r in rows])
    y = np.array([r[0] for r in rows])
    w = np.zeros(d)
    for i in range(4):
        w -= (x @ w - y) @ x / (len(y) * np.sqrt(i + 1))
    assert len(found.weights) == d and np.allclose(found.weights, w)


def test_least_squares_of_columns_that_depend_on_each_other(spark):
    df, x, y = points(spark, d=3)
    whole = two_way_interactions(df, width=3)
    model = lin.fit_interactions(df, width=3)
    z = np.hstack([x, (x[:, :, None] * x[:, None, :]).reshape(len(x), 9)])
    scaled = (z - z.mean(0)) / z.std(0)
    expected = np.linalg.pinv(scaled, rcond=1e-10) @ (y - y.mean()) / z.std(0)
    assert np.allclose(model.coefficients, expected, rtol=1e-5)
    grid = np.array(model.coefficients[3:]).reshape(3, 3)
    assert np.allclose(grid, grid.T, rtol=1e-9)
    found = lin.apply_model(whole, model).agg(F.avg(F.col("prediction") - F.col("label"))).first()[0]
    assert abs(found) < 1e-9


def test_path_gives_the_models_of_single_fits(spark, monkeypatch):
    df, x, y = points(spark, n=600, d=5)
    train, validation = df.limit(400), df.limit(200)
    passes = []
    monkeypatch.setattr(lin, "moments", lambda *a, real=lin.moments: passes.append(a) or real(*a))
    path = lin.path_search(train, validation)
    assert len(passes) == 1
    single = lin.grid_search(train, validation, tol=1e-12)
    assert path.best_reg == single.best_reg
    assert np.allclose([e for _, e in path.trials], [e for _, e in single.trials], rtol=1e-6)
    for a, b in zip(path.models, single.models):
        assert np.allclose(a.coefficients, b.coefficients, atol=1e-6)
        assert a.intercept == pytest.approx(b.intercept, abs=1e-6)


def test_path_over_dependent_and_constant_columns_meets_the_optimum(spark):
    df, x, y = points(spark, n=300, d=3)
    copied = df.withColumn("features", F.concat("features", "features", F.array(F.lit(2.0))))
    z = np.hstack([x, x])
    scaled, label = (z - z.mean(0)) / z.std(0), (y - y.mean()) / y.std()
    regs = [0.5, 1e-3, 1e-10]
    for reg, model in zip(regs, lin.regularization_path(copied, regs)):
        assert model.coefficients[6] == 0.0
        w = np.array(model.coefficients[:6]) * z.std(0) / y.std()
        slope = scaled.T @ (scaled @ w - label) / len(y) + 0.8 * reg / y.std() * w
        l1 = 0.2 * reg / y.std()
        off = np.where(w != 0, np.abs(slope + l1 * np.sign(w)), np.maximum(np.abs(slope) - l1, 0))
        assert off.max() < 1e-9


def clicks(spark, n=3000):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(n):
        pairs = [(0, f"a{draw.integers(3)}"), (1, "rare" if i == 7 else f"b{draw.integers(4)}")]
        rows.append((i, float(draw.random() < 0.3), pairs))
    return spark.createDataFrame(rows, "row long, label double, feature array<struct<_1: short, _2: string>>")


@pytest.mark.parametrize("kind", ["one_hot", "hashed"])
def test_an_altered_rare_coefficient_shows(spark, kind):
    df = clicks(spark)
    if kind == "one_hot":
        rows = one_hot_encode(df, build_dictionary(df), width=2, keep=["label"])
        model = fit_logistic(rows, maxIter=500, tol=1e-14)
    else:
        rows = hash_features(df, keep=["label"], buckets=64)
        model = fit_logistic_hashed(rows, regParam=1e-4, maxIter=500, tol=1e-14)
    found = {r.idx: r for r in optimality(rows, model).collect()}
    assert set(found) == set(range(-1, model.numFeatures))
    assert found[-1].n_rows == 3000 and max(r.excess for r in found.values()) < 1e-3
    idx = next(i for i, r in found.items() if r.n_rows == 1)
    weights = model.coefficients.toArray().copy()
    weights[idx] += 0.01
    jvm = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    altered = type(model)(jvm("altered", lin._py2java(spark.sparkContext, Vectors.dense(weights)), float(model.intercept)))
    altered.set(altered.regParam, model.getRegParam())
    altered.set(altered.elasticNetParam, model.getElasticNetParam())
    assert {r.idx: r for r in optimality(rows, altered).collect()}[idx].excess > 2e-3


def test_sparsity_without_vectors(spark):
    df = clicks(spark, 200)
    dictionary = build_dictionary(df.filter("row < 100"))
    one_hot, hashed = one_hot_encode(df, dictionary, written=True), hash_features(df)
    expected = [mean_sparsity(one_hot).first()[0], mean_sparsity(hashed).first()[0]]
    for options in ({}, {"row_id": "row", "broadcast_bytes": 0}):
        found = {r.encoding: r.sparsity for r in encoding_sparsity(df, dictionary, **options).collect()}
        assert found == pytest.approx(dict(zip(["one_hot", "hashed"], expected)))
    plan = one_hot._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "JsonToStructs" not in plan


@pytest.mark.parametrize("query", [plans.interactions, plans.poly_expand])
def test_products_are_worked_out_once(spark, query):
    plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if line.lstrip(" +-:").startswith(("Filter", "DataFilters")):
            assert "replace(" not in line
    assert plan.count("size(features") <= 2


def test_copies_of_one_line_are_split_by_many_tasks(spark, tmp_path):
    (tmp_path / "lines").write_text("1.5,2.0,3.0\n" * 1_000_000 + "2.5,1.0,1.0\n" * 3)
    rows = jobs._numbered(read_lines(spark, str(tmp_path / "lines")), parse_numeric_points, "points")
    shares = {r["split"]: r["count"] / 1e6 for r in rows.filter("label = 1.5").groupBy("split").count().collect()}
    assert sum(shares.values()) == pytest.approx(1.0, abs=1e-12)
    assert shares == pytest.approx({"train": 0.8, "validation": 0.1, "test": 0.1}, abs=0.005)
    assert rows.filter("label = 2.5").count() == 3
    tasks = rows.filter("label = 1.5").groupBy(F.shiftright("row", 33)).count().collect()
    assert len(tasks) >= 4 and max(t["count"] for t in tasks) < 500_000
