import numpy as np
import pytest

from fieldloom.operators.pca import center, column_means, covariance, moments, pca, variance_explained

ROWS = np.arange(20, dtype=float).reshape(5, 4)


def frame(spark, rows):
    return spark.createDataFrame([(row.tolist(),) for row in rows], "features array<double>")


def correlated(cov):
    state = np.random.RandomState(142)
    return state.multivariate_normal([50, 50], [[1, cov], [cov, 1]], 100)


def test_means_and_centering(spark):
    df = frame(spark, ROWS)
    means = {row.i: row["mean"] for row in column_means(df).collect()}
    assert means == {0: 8.0, 1: 9.0, 2: 10.0, 3: 11.0}
    rows = [row.centered for row in center(df).collect()]
    assert np.allclose(rows, ROWS - ROWS.mean(axis=0))


def test_covariance_divides_by_n(spark):
    assert all(row.cov == pytest.approx(32.0) for row in covariance(frame(spark, ROWS)).collect())


@pytest.mark.parametrize("d", [2, 16, 17, 40])
def test_moments_against_numpy(spark, d):
    rows = np.random.default_rng(d).standard_normal((200, d)) + 1000.0
    rows[:, 0] = 7.0
    found = moments(frame(spark, rows))
    assert found.count == 200
    assert np.allclose(found.mean, rows.mean(axis=0))
    assert np.allclose(found.covariance, np.cov(rows.T, bias=True), atol=1e-10)


def test_pca_exact(spark):
    result = pca(frame(spark, ROWS), k=3)
    assert np.allclose(result.eigenvalues, [128, 0, 0, 0], atol=1e-9)
    assert np.allclose(result.components[:, 0], [0.5] * 4)
    assert result.components.shape == (4, 3)
    assert result.scores.first().scores[0] == pytest.approx(3.0)


def test_pca_correlated(spark):
    rows = correlated(0.9)
    result = pca(frame(spark, rows), k=2)
    values, vectors = np.linalg.eigh(np.cov(rows.T, bias=True))
    assert np.allclose(result.eigenvalues, values[::-1])
    assert np.allclose(np.abs(result.components), np.abs(vectors[:, ::-1]))
    found = np.array([row.scores for row in result.scores.collect()])
    assert np.allclose(found, rows @ result.components)
    one = pca(frame(spark, rows), k=1)
    assert np.allclose(one.components[:, 0], result.components[:, 0])
    assert np.allclose(one.eigenvalues, result.eigenvalues)


def test_largest_loading_is_positive(spark):
    rows = np.random.default_rng(1).standard_normal((100, 6))
    components = pca(frame(spark, rows), k=6).components
    assert all(column[np.abs(column).argmax()] > 0 for column in components.T)


@pytest.mark.parametrize("d, k", [(20, 2), (80, 3), (20, 20)])
def test_scores_of_wide_rows(spark, d, k):
    rows = np.random.default_rng(d).standard_normal((60, d)) + 2.0
    result = pca(frame(spark, rows), k=k)
    found = {tuple(row.features): row.scores for row in result.scores.collect()}
    assert all(np.allclose(found[tuple(row)], row @ result.components) for row in rows.tolist())


def test_variance_explained(spark):
    rows = correlated(0.9)
    values = np.linalg.eigvalsh(np.cov(rows.T, bias=True))[::-1]
    df = frame(spark, rows)
    assert variance_explained(df, k=1) == pytest.approx(values[0] / values.sum())
    assert variance_explained(df, k=2) == pytest.approx(1.0)


@pytest.mark.parametrize("d", [2, 16, 17, 64, 65])
@pytest.mark.parametrize("fault", ["long", "short", "null entry", "null row", "width"])
def test_uneven_rows_are_an_error(spark, d, fault):
    rows = [[float(i + j) for j in range(d)] for i in range(4)]
    width = d
    if fault == "long":
        rows.append([1.0] * (d + 1))
    elif fault == "short":
        rows.append([1.0] * (d - 1))
    elif fault == "null entry":
        rows.append([1.0] * (d - 1) + [None])
    elif fault == "null row":
        rows.append(None)
    else:
        width = d + 1
    df = spark.createDataFrame([(row,) for row in rows], "features array<double>")
    with pytest.raises(ValueError, match="numbers"):
        moments(df, width=width)


@pytest.mark.parametrize("d", [16, 17])
def test_small_columns_keep_their_covariance(spark, d):
    draw = np.random.default_rng(d)
    rows = 1e-7 * (draw.standard_normal((300, 1)) + 0.1 * draw.standard_normal((300, d)))
    expected = np.cov(rows.T, bias=True)
    found = moments(frame(spark, rows)).covariance
    assert np.allclose(found, expected, rtol=1e-6, atol=0)


def test_k_out_of_range(spark):
    with pytest.raises(ValueError):
        pca(frame(spark, ROWS), k=5)
