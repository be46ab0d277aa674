"""Means, covariance and principal components."""

from pyspark.sql import functions as F

from ..operators import pca as ops
from ..sources import read_table
from .inputs import DOCUMENT_SIZES_SQL, document_sizes, rounded


def column_means(spark, folder):
    means = ops.column_means(read_table(spark, folder, "embeddings"), "embedding")
    return means.select(F.col("i").cast("bigint").alias("i"), rounded("mean").alias("mean"))


def centered_rows(spark, folder):
    rows = ops.center(document_sizes(spark, folder))
    return rows.select(
        "doc_id", *[rounded(F.get("centered", F.lit(i))).alias(f"c{i}") for i in range(2)]
    )


def _covariance(df, features, width=None):
    return ops.covariance(df, features, width).select(
        F.col("i").cast("bigint").alias("i"),
        F.col("j").cast("bigint").alias("j"),
        rounded("cov").alias("cov"),
    )


def covariance(spark, folder):
    return _covariance(read_table(spark, folder, "embeddings"), "embedding")


def covariance_2d(spark, folder):
    return _covariance(document_sizes(spark, folder), "features", 2)


def pca_explained(spark, folder):
    result = ops.pca(document_sizes(spark, folder), k=2, width=2)
    rows = [(k, round(result.variance_explained(k), 6)) for k in (1, 2)]
    return spark.createDataFrame(rows, "k long, share double")


def pca_eigenvalues_2d(spark, folder):
    result = ops.pca(document_sizes(spark, folder), k=2, width=2)
    rows = [(i, round(float(x), 5)) for i, x in enumerate(result.eigenvalues)]
    return spark.createDataFrame(rows, "component long, eigenvalue double")


def pca_components_2d(spark, folder):
    result = ops.pca(document_sizes(spark, folder), k=2, width=2)
    return ops.matrix_table(spark, result.components, "loading").select(
        F.col("j").cast("bigint").alias("component"),
        F.col("i").cast("bigint").alias("i"),
        rounded("loading").alias("loading"),
    )


def pca_scores_2d(spark, folder):
    scores = ops.pca(document_sizes(spark, folder), k=2, width=2).scores
    return scores.select(
        "doc_id", *[rounded(F.get("scores", F.lit(i)), 5).alias(f"score{i}") for i in range(2)]
    )


def pca_eigen_moments(spark, folder):
    values = ops.pca(read_table(spark, folder, "embeddings"), "embedding", k=2).eigenvalues
    rows = [(round(float(values.sum()), 6), round(float((values**2).sum()), 6))]
    return spark.createDataFrame(rows, "total double, total_squares double")


def pca_leading(spark, folder):
    vectors = read_table(spark, folder, "embeddings")
    found = ops.leading_components(vectors, "embedding", k=1)
    rows = [(round(float(found.eigenvalues[0]), 6), round(found.total, 6), round(found.variance_explained(), 6))]
    return spark.createDataFrame(rows, "eigenvalue double, total double, share double")


QUERIES = {
    "column_means": column_means,
    "centered_rows": centered_rows,
    "covariance": covariance,
    "covariance_2d": covariance_2d,
    "pca_explained": pca_explained,
    "pca_eigenvalues_2d": pca_eigenvalues_2d,
    "pca_components_2d": pca_components_2d,
    "pca_scores_2d": pca_scores_2d,
    "pca_eigen_moments": pca_eigen_moments,
    "pca_leading": pca_leading,
}

_LONG_SQL = """
entries AS (
  SELECT vec_id, generate_subscripts(embedding, 1)::BIGINT - 1 AS i,
         unnest(embedding)::DOUBLE AS x
  FROM embeddings),
cov AS (
  SELECT a.i AS i, b.i AS j, covar_pop(a.x, b.x) AS cov
  FROM entries a JOIN entries b USING (vec_id) GROUP BY a.i, b.i)"""

# Eigenvalues and unit eigenvectors of a 2 x 2 matrix ((a, b), (b, c)), each
# vector turned so that its larger entry by magnitude is positive.
_EIGEN_SQL = f"""{DOCUMENT_SIZES_SQL},
m AS (
  SELECT covar_pop(x1, x1) AS a, covar_pop(x1, x2) AS b, covar_pop(x2, x2) AS c FROM sized),
l AS (
  SELECT a, b, (a + c) / 2 + sqrt(power((a - c) / 2, 2) + b*b) AS l1,
         (a + c) / 2 - sqrt(power((a - c) / 2, 2) + b*b) AS l2 FROM m),
v AS (
  SELECT l1, l2, b / sqrt(b*b + power(l1 - a, 2)) AS u, (l1 - a) / sqrt(b*b + power(l1 - a, 2)) AS w
  FROM l),
e AS (
  SELECT l1, l2,
         u * sign(CASE WHEN abs(u) > abs(w) THEN u ELSE w END) AS p0,
         w * sign(CASE WHEN abs(u) > abs(w) THEN u ELSE w END) AS p1,
         -w * sign(CASE WHEN abs(u) > abs(w) THEN u ELSE -w END) AS q0,
         u * sign(CASE WHEN abs(u) > abs(w) THEN u ELSE -w END) AS q1
  FROM v)"""

ORACLES = {
    "column_means": f"""WITH {_LONG_SQL}
  SELECT i, round(avg(x), 6) + 0.0 AS mean FROM entries GROUP BY i""",
    "centered_rows": f"""WITH {DOCUMENT_SIZES_SQL}
  SELECT doc_id, round(x1 - (SELECT avg(x1) FROM sized), 6) + 0.0 AS c0,
         round(x2 - (SELECT avg(x2) FROM sized), 6) + 0.0 AS c1
  FROM sized""",
    "covariance": f"WITH {_LONG_SQL} SELECT i, j, round(cov, 6) + 0.0 AS cov FROM cov",
    "covariance_2d": f"""WITH {DOCUMENT_SIZES_SQL}
  SELECT 0::BIGINT AS i, 0::BIGINT AS j, round(covar_pop(x1, x1), 6) AS cov FROM sized
  UNION ALL SELECT 0, 1, round(covar_pop(x1, x2), 6) FROM sized
  UNION ALL SELECT 1, 0, round(covar_pop(x1, x2), 6) FROM sized
  UNION ALL SELECT 1, 1, round(covar_pop(x2, x2), 6) FROM sized""",
    "pca_explained": f"""WITH {_EIGEN_SQL}
  SELECT 1::BIGINT AS k, round(l1 / (l1 + l2), 6) AS share FROM e
  UNION ALL SELECT 2, 1.0 FROM e""",
    "pca_eigenvalues_2d": f"""WITH {_EIGEN_SQL}
  SELECT 0::BIGINT AS component, round(l1, 5) AS eigenvalue FROM e
  UNION ALL SELECT 1, round(l2, 5) FROM e""",
    "pca_components_2d": f"""WITH {_EIGEN_SQL}
  SELECT 0::BIGINT AS component, 0::BIGINT AS i, round(p0, 6) + 0.0 AS loading FROM e
  UNION ALL SELECT 0, 1, round(p1, 6) + 0.0 FROM e
  UNION ALL SELECT 1, 0, round(q0, 6) + 0.0 FROM e
  UNION ALL SELECT 1, 1, round(q1, 6) + 0.0 FROM e""",
    "pca_scores_2d": f"""WITH {_EIGEN_SQL}
  SELECT doc_id, round(x1*p0 + x2*p1, 5) + 0.0 AS score0, round(x1*q0 + x2*q1, 5) + 0.0 AS score1
  FROM sized, e""",
    "pca_eigen_moments": f"""WITH {_LONG_SQL}
  SELECT round(sum(cov) FILTER (WHERE i = j), 6) AS total, round(sum(cov * cov), 6) AS total_squares
  FROM cov""",
    # Squared again and again, and held at trace 1, the matrix becomes the projection on
    # its top component.
    "pca_leading": f"""WITH RECURSIVE {_LONG_SQL},
powers AS (
  SELECT 0 AS k, i, j, cov / (SELECT sum(cov) FROM cov WHERE i = j) AS c FROM cov
  UNION ALL
  SELECT k, i, j, c / sum(CASE WHEN i = j THEN c END) OVER ()
  FROM (SELECT a.k + 1 AS k, a.i AS i, b.j AS j, sum(a.c * b.c) AS c
        FROM powers a JOIN powers b ON a.j = b.i WHERE a.k < 24 GROUP BY a.k, a.i, b.j)),
top AS (SELECT sum(cov * c) AS l FROM cov JOIN powers USING (i, j) WHERE k = 24),
t AS (SELECT sum(cov) AS total FROM cov WHERE i = j)
  SELECT round(l, 6) AS eigenvalue, round(total, 6) AS total, round(l / total, 6) AS share FROM top, t""",
}
