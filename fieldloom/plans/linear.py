"""Gradient descent, linear models, interactions and model comparison."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.vectors import dense_vector
from ..operators import expand
from ..operators import linear as lin
from ..operators.evaluate import add_baseline, compare_models, rmse
from ..operators.encode import hash_features
from ..operators.parse import parse_numeric_points, shift_label
from ..operators.split import with_split
from .encoding import bucket_sql
from .inputs import (
    CLICKS_SQL,
    DOCUMENT_SIZES_SQL,
    ORDER_POINTS_SQL,
    PRICE_POINTS_SQL,
    clicks,
    document_sizes,
    order_point_lines,
    price_points,
    rounded,
    split_sql,
)

_ITERATIONS = 50
_SPARSE_ITERATIONS = 3
_BUCKETS = 32768
_WEIGHTS = (0.5, -1.0, 2.0)
_EXACT = {"tol": 1e-12}
# Products that are nearly multiples of each other need many steps, all of them on moments.
_PATIENT = {"tol": 1e-16, "maxIter": 20000}


def _part(df, name):
    return df.filter(F.col("split") == name)


def _rmse_by_split(df):
    error = rmse(F.col("prediction"), F.col("label"))
    return df.groupBy("split").agg(rounded(error, 4).alias("rmse"))


def gradient_summands(spark, folder):
    points = parse_numeric_points(order_point_lines(spark, folder))
    summands = lin.gradient_summand(points, _WEIGHTS)
    return summands.select(
        "o_orderkey", *[F.get("summand", F.lit(i)).alias(f"g{i}") for i in range(3)]
    )


def gradient_sum(spark, folder):
    points = parse_numeric_points(order_point_lines(spark, folder))
    total = lin.vector_sum(lin.gradient_summand(points, _WEIGHTS))
    # Labels are years: sums grow with the rows, means do not.
    rows = points.agg(F.count(F.lit(1))).scalar()
    return total.select(
        F.col("i").cast("bigint").alias("i"), rounded(F.col("total") / rows).alias("mean_gradient")
    )


def linear_predictions(spark, folder):
    points = parse_numeric_points(order_point_lines(spark, folder))
    return lin.linear_prediction(points, _WEIGHTS)


def gd_weights(spark, folder):
    result = lin.linreg_gradient_descent(price_points(spark, folder), _ITERATIONS, width=3)
    rows = [(i, round(w, 6) + 0.0) for i, w in enumerate(result.weights)]
    return spark.createDataFrame(rows, "idx long, weight double")


def gd_error_curve(spark, folder):
    result = lin.linreg_gradient_descent(price_points(spark, folder), _ITERATIONS, width=3)
    rows = [(i, round(error, 6) + 0.0) for i, error in enumerate(result.errors)]
    return spark.createDataFrame(rows, "iteration long, rmse double")


def gd_sparse_weights(spark, folder):
    """Descent on hashed categories, 32,768 features of which a row has four."""
    rows = _part(clicks(spark, folder), "train")
    hashed = hash_features(rows, keep=["label"], buckets=_BUCKETS, written=True)
    result = lin.linreg_gradient_descent_sparse(hashed, _SPARSE_ITERATIONS)
    rows = [(i, round(w, 6) + 0.0) for i, w in enumerate(result.weights)]
    return spark.createDataFrame(rows, "idx long, weight double")


def linreg_ols(spark, folder):
    points = price_points(spark, folder)
    table_of = lin.coefficient_table(points, lin.fit_linear(points, regParam=0.0))
    return table_of.select(
        F.col("idx").cast("bigint").alias("idx"), rounded("coefficient").alias("coefficient")
    )


def linreg_elastic(spark, folder):
    points = document_sizes(spark, folder)
    table_of = lin.coefficient_table(points, lin.fit_linear(points, **_EXACT))
    return table_of.select(
        F.col("idx").cast("bigint").alias("idx"), rounded("coefficient", 4).alias("coefficient")
    )


def linreg_predictions(spark, folder):
    points = document_sizes(spark, folder)
    # Without penalty the fit is exact, so that no prediction sits on a rounding border.
    scored = lin.apply_model(points, lin.fit_linear(_part(points, "train"), regParam=0.0))
    return scored.select("doc_id", rounded("prediction", 5).alias("prediction"))


def linreg_grid(spark, folder):
    points = document_sizes(spark, folder)
    result = lin.grid_search(_part(points, "train"), _part(points, "validation"), **_EXACT)
    rows = [(reg, round(error, 4), reg == result.best_reg) for reg, error in result.trials]
    return spark.createDataFrame(rows, "reg_param double, rmse double, chosen boolean")


def linreg_path(spark, folder):
    points = document_sizes(spark, folder)
    result = lin.path_search(_part(points, "train"), _part(points, "validation"), width=2)
    rows = [(reg, round(error, 4), reg == result.best_reg) for reg, error in result.trials]
    return spark.createDataFrame(rows, "reg_param double, rmse double, chosen boolean")


def _positions(df, column):
    """Rows (doc_id, i, x) of an array. A plain explode would have the optimizer filter
    out empty arrays at the scan, which builds the array there a second time."""
    rows = df.select("doc_id", F.posexplode_outer(column).alias("i", "x")).filter("i is not null")
    return rows.select("doc_id", F.col("i").cast("bigint").alias("i"), rounded("x").alias("x"))


def interactions(spark, folder):
    return _positions(expand.two_way_interactions(document_sizes(spark, folder), width=2), "features")


def poly_expand(spark, folder):
    expanded = expand.polynomial(document_sizes(spark, folder))
    return _positions(expanded, vector_to_array("polyFeatures"))


def interaction_model(spark, folder):
    points = document_sizes(spark, folder)
    model = lin.fit_interactions(_part(points, "train"), width=2)
    return _rmse_by_split(lin.apply_model(expand.two_way_interactions(points, width=2), model))


def polynomial_pipeline(spark, folder):
    points = document_sizes(spark, folder)
    vectors = points.withColumn("features", dense_vector(F.col("features")))
    model = lin.fit_polynomial_pipeline(_part(vectors, "train"), **_PATIENT)
    return _rmse_by_split(model.transform(vectors))


def pipeline_mean_identity(spark, folder):
    points = document_sizes(spark, folder)
    vectors = points.withColumn("features", dense_vector(F.col("features")))
    scored = lin.fit_polynomial_pipeline(vectors).transform(vectors)
    return scored.agg(
        rounded(F.avg("prediction")).alias("mean_prediction"),
        rounded(F.avg("label")).alias("mean_label"),
    )


def model_comparison(spark, folder):
    points = parse_numeric_points(order_point_lines(spark, folder))
    points = with_split(shift_label(points), "o_orderkey")
    train = _part(points, "train")
    descent = lin.linreg_gradient_descent(train, _ITERATIONS, width=3)
    scored = add_baseline(points, train, output="baseline")
    scored = scored.withColumn("descent", lin.dot(F.col("features"), descent.weights))
    scored = lin.apply_model(scored, lin.fit_linear(train, regParam=0.0), output="least_squares")
    models = {name: name for name in ("baseline", "descent", "least_squares")}
    compared = compare_models(scored, models, "rmse")
    return compared.withColumn("value", rounded("value"))


QUERIES = {
    "gradient_summands": gradient_summands,
    "gradient_sum": gradient_sum,
    "linear_predictions": linear_predictions,
    "gd_weights": gd_weights,
    "gd_error_curve": gd_error_curve,
    "gd_sparse_weights": gd_sparse_weights,
    "linreg_ols": linreg_ols,
    "linreg_elastic": linreg_elastic,
    "linreg_predictions": linreg_predictions,
    "linreg_grid": linreg_grid,
    "linreg_path": linreg_path,
    "interactions": interactions,
    "poly_expand": poly_expand,
    "interaction_model": interaction_model,
    "polynomial_pipeline": polynomial_pipeline,
    "pipeline_mean_identity": pipeline_mean_identity,
    "model_comparison": model_comparison,
}

_DOT = "(0.5 * x0 - 1.0 * x1 + 2.0 * x2)"

def _moments_sql(rows: str) -> str:
    return f"""m AS (
  SELECT count(*)::DOUBLE AS n, sum(x1*x1) AS a11, sum(x1*x2) AS a12, sum(x1*x3) AS a13,
         sum(x2*x2) AS a22, sum(x2*x3) AS a23, sum(x3*x3) AS a33,
         sum(x1*y) AS b1, sum(x2*y) AS b2, sum(x3*y) AS b3
  FROM {rows}),
w AS (
  SELECT 0 AS i, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 0.0::DOUBLE AS w3
  UNION ALL
  SELECT i + 1, w1 - (a11*w1 + a12*w2 + a13*w3 - b1) / (n * sqrt(i + 1)),
         w2 - (a12*w1 + a22*w2 + a23*w3 - b2) / (n * sqrt(i + 1)),
         w3 - (a13*w1 + a23*w2 + a33*w3 - b3) / (n * sqrt(i + 1))
  FROM w, m WHERE i < {_ITERATIONS})"""


_DESCENT_SQL = f"""WITH RECURSIVE {PRICE_POINTS_SQL},
{_moments_sql("prices")}"""


def _sparse_sql() -> str:
    """Steps of the descent over (row, bucket) pairs, one after the other."""
    steps = ["w0 AS (SELECT range AS bucket, 0.0::DOUBLE AS w FROM range({0}))".format(_BUCKETS)]
    for i in range(_SPARSE_ITERATIONS):
        steps.append(f"""r{i} AS (
  SELECT o_orderkey, sum(w * hits) - any_value(label) AS r
  FROM hits JOIN w{i} USING (bucket) GROUP BY o_orderkey),
g{i} AS (
  SELECT bucket, sum(r * hits) / (SELECT count(*) FROM r{i}) AS g
  FROM hits JOIN r{i} USING (o_orderkey) GROUP BY bucket),
w{i + 1} AS (
  SELECT bucket, w - coalesce(g, 0) / sqrt({i + 1}) AS w FROM w{i} LEFT JOIN g{i} USING (bucket))""")
    bucket = bucket_sql("category || ':' || feature_id", _BUCKETS)
    return f"""WITH {CLICKS_SQL},
hits AS (
  SELECT o_orderkey, any_value(label) AS label, {bucket} AS bucket, count(*)::DOUBLE AS hits
  FROM pairs JOIN clicks USING (o_orderkey) WHERE pairs.split = 'train' GROUP BY o_orderkey, bucket),
{",".join(steps)}
  SELECT bucket AS idx, round(w, 6) + 0.0 AS weight FROM w{_SPARSE_ITERATIONS}"""


def _residuals_sql(source: str, columns: list[str], label: str) -> str:
    """Tables q0, q1, ... that take one column after the other out of all columns behind it
    and out of the label, by regression on the training rows. In the last one, ``y`` is
    what a least squares model of all columns leaves of the label."""
    k = len(columns)
    names = [f"r{j}" for j in range(k)]
    raw = ", ".join(f"{c} AS c{j}" for j, c in enumerate(columns))
    centered = ", ".join(f"c{j} - m{j} AS r{j}" for j in range(k))
    means = ", ".join(f"avg(c{j}) AS m{j}" for j in range(k))
    steps = [f"""raw AS (SELECT split, {label} AS l, {raw} FROM {source}),
q0 AS (
  SELECT split, l - ml AS y, {centered}
  FROM raw, (SELECT avg(l) AS ml, {means} FROM raw WHERE split = 'train'))"""]
    for i in range(k):
        later = [*names[i + 1 :], "y"]
        moved = ", ".join(f"{c} - b_{c} * r{i} AS {c}" for c in later)
        slopes = ", ".join(f"sum({c} * r{i}) / sum(r{i} * r{i}) AS b_{c}" for c in later)
        steps.append(f"""q{i + 1} AS (
  SELECT split, {moved}
  FROM q{i}, (SELECT {slopes} FROM q{i} WHERE split = 'train'))""")
    return ",\n".join(steps)


def _elastic_sql(rows: str, regs: str = "0.1") -> str:
    """Elastic nets on two features, from their moments, by coordinate descent."""
    soft = lambda z: f"sign({z}) * greatest(abs({z}) - 0.2 * reg / sy, 0) / (1 + 0.8 * reg / sy)"
    return f"""WITH RECURSIVE {DOCUMENT_SIZES_SQL},
m AS (
  SELECT avg(x1) AS mx1, avg(x2) AS mx2, avg(y) AS my, stddev_pop(x1) AS s1,
         stddev_pop(x2) AS s2, stddev_pop(y) AS sy, corr(x1, y) AS r1, corr(x2, y) AS r2,
         corr(x1, x2) AS r12
  FROM sized WHERE {rows}),
g AS (SELECT unnest([{regs}]::DOUBLE[]) AS reg),
d AS (
  SELECT reg, 0 AS k, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 FROM g
  UNION ALL
  SELECT reg, k + 1, a, {soft("(r2 - r12 * a)")}
  FROM (SELECT d.reg, k, sy, r2, r12, {soft("(r1 - r12 * w2)")} AS a FROM d, m WHERE k < 500)),
f AS (
  SELECT reg, w1 * sy / s1 AS b1, w2 * sy / s2 AS b2,
         my - w1 * sy / s1 * mx1 - w2 * sy / s2 * mx2 AS b0
  FROM d, m WHERE k = 500)"""


def _least_squares_rmse_sql(columns: list[str]) -> str:
    return f"""WITH {DOCUMENT_SIZES_SQL},
{_residuals_sql("sized", columns, "y")}
  SELECT split, round(sqrt(avg(y * y)), 4) AS rmse FROM q{len(columns)} GROUP BY split"""


_GRID_SQL = f"""{_elastic_sql("split = 'train'", "0.1, 1e-10, 1e-5, 1e-2, 1.0")},
e AS (
  SELECT reg, sqrt(avg(power(b0 + b1*x1 + b2*x2 - y, 2))) AS rmse
  FROM f, sized WHERE split = 'validation' GROUP BY reg)
  SELECT reg AS reg_param, round(rmse, 4) AS rmse, rmse = (SELECT min(rmse) FROM e) AS chosen
  FROM e"""

ORACLES = {
    "gradient_summands": f"""WITH {ORDER_POINTS_SQL}
  SELECT o_orderkey, ({_DOT} - label) * x0 AS g0, ({_DOT} - label) * x1 AS g1,
         ({_DOT} - label) * x2 AS g2
  FROM points""",
    "gradient_sum": f"""WITH {ORDER_POINTS_SQL}
  SELECT 0::BIGINT AS i, round(avg(({_DOT} - label) * x0), 6) + 0.0 AS mean_gradient FROM points
  UNION ALL SELECT 1, round(avg(({_DOT} - label) * x1), 6) + 0.0 FROM points
  UNION ALL SELECT 2, round(avg(({_DOT} - label) * x2), 6) + 0.0 FROM points""",
    "linear_predictions": f"""WITH {ORDER_POINTS_SQL}
  SELECT {_DOT} AS prediction, label FROM points""",
    "gd_weights": f"""{_DESCENT_SQL}
  SELECT 0::BIGINT AS idx, round(w1, 6) AS weight FROM w WHERE i = {_ITERATIONS}
  UNION ALL SELECT 1, round(w2, 6) FROM w WHERE i = {_ITERATIONS}
  UNION ALL SELECT 2, round(w3, 6) FROM w WHERE i = {_ITERATIONS}""",
    "gd_sparse_weights": _sparse_sql(),
    "gd_error_curve": f"""{_DESCENT_SQL}
  SELECT i::BIGINT AS iteration, round(sqrt(avg(power(w1*x1 + w2*x2 + w3*x3 - y, 2))), 6) AS rmse
  FROM w, prices WHERE i < {_ITERATIONS} GROUP BY i""",
    # Three normal equations, solved by Cramer's rule.
    "linreg_ols": f"""WITH {PRICE_POINTS_SQL},
s AS (
  SELECT covar_pop(x1, x1) AS a, covar_pop(x1, x2) AS b, covar_pop(x1, x3) AS c,
         covar_pop(x2, x2) AS d, covar_pop(x2, x3) AS e, covar_pop(x3, x3) AS f,
         covar_pop(x1, y) AS p, covar_pop(x2, y) AS q, covar_pop(x3, y) AS r,
         avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my
  FROM prices),
w AS (
  SELECT (p*(d*f - e*e) - b*(q*f - e*r) + c*(q*e - d*r)) / det AS b1,
         (a*(q*f - e*r) - p*(b*f - e*c) + c*(b*r - q*c)) / det AS b2,
         (a*(d*r - q*e) - b*(b*r - q*c) + p*(b*e - d*c)) / det AS b3, m1, m2, m3, my
  FROM (SELECT *, a*(d*f - e*e) - b*(b*f - e*c) + c*(b*e - d*c) AS det FROM s))
  SELECT -1::BIGINT AS idx, round(my - b1*m1 - b2*m2 - b3*m3, 6) + 0.0 AS coefficient FROM w
  UNION ALL SELECT 0, round(b1, 6) + 0.0 FROM w
  UNION ALL SELECT 1, round(b2, 6) + 0.0 FROM w
  UNION ALL SELECT 2, round(b3, 6) + 0.0 FROM w""",
    "linreg_elastic": f"""{_elastic_sql("true")}
  SELECT -1::BIGINT AS idx, round(b0, 4) + 0.0 AS coefficient FROM f
  UNION ALL SELECT 0, round(b1, 4) + 0.0 FROM f
  UNION ALL SELECT 1, round(b2, 4) + 0.0 FROM f""",
    "linreg_predictions": f"""{_elastic_sql("split = 'train'", "0.0")}
  SELECT doc_id, round(b0 + b1*x1 + b2*x2, 5) + 0.0 AS prediction FROM sized, f""",
    "linreg_grid": _GRID_SQL,
    "linreg_path": _GRID_SQL,
    "interactions": f"""WITH {DOCUMENT_SIZES_SQL}
  SELECT doc_id, generate_subscripts(v, 1)::BIGINT - 1 AS i, round(unnest(v), 6) AS x
  FROM (SELECT doc_id, [x1, x2, x1*x1, x1*x2, x2*x1, x2*x2] AS v FROM sized)""",
    "poly_expand": f"""WITH {DOCUMENT_SIZES_SQL}
  SELECT doc_id, generate_subscripts(v, 1)::BIGINT - 1 AS i, round(unnest(v), 6) AS x
  FROM (SELECT doc_id, [x1, x1*x1, x2, x1*x2, x2*x2] AS v FROM sized)""",
    # x2*x1 adds nothing to x1*x2.
    "interaction_model": _least_squares_rmse_sql(["x1", "x2", "x1*x1", "x1*x2", "x2*x2"]),
    "polynomial_pipeline": _least_squares_rmse_sql(["x1", "x1*x1", "x2", "x1*x2", "x2*x2"]),
    "pipeline_mean_identity": f"""WITH {DOCUMENT_SIZES_SQL}
  SELECT round(avg(y), 6) AS mean_prediction, round(avg(y), 6) AS mean_label FROM sized""",
    "model_comparison": f"""WITH RECURSIVE {ORDER_POINTS_SQL},
parts AS (
  SELECT label - (SELECT min(label) FROM points) AS y, x0 AS x1, x1 AS x2, x2 AS x3,
         {split_sql("o_orderkey")} AS split
  FROM points),
train AS (SELECT * FROM parts WHERE split = 'train'),
{_moments_sql("train")},
{_residuals_sql("parts", ["x1", "x2", "x3"], "y")},
p AS (
  SELECT split, y - (SELECT avg(y) FROM train) AS baseline, y - w1*x1 - w2*x2 - w3*x3 AS descent
  FROM parts, w WHERE i = {_ITERATIONS})
  SELECT 'baseline' AS model, split, 'rmse' AS metric,
         round(sqrt(avg(power(baseline, 2))), 6) AS value FROM p GROUP BY split
  UNION ALL SELECT 'descent', split, 'rmse', round(sqrt(avg(power(descent, 2))), 6)
  FROM p GROUP BY split
  UNION ALL SELECT 'least_squares', split, 'rmse', round(sqrt(avg(y * y)), 6) FROM q3 GROUP BY split""",
}
