"""Log loss, probabilities and logistic models."""

from pyspark.sql import functions as F

from ..functions.numeric import clamped_sigmoid, dot
from ..operators.encode import build_dictionary, hash_features, one_hot_encode
from ..operators.evaluate import (
    add_log_loss,
    compare_models,
    evaluate_results,
    mean_log_loss,
)
from ..operators.logistic import (
    HASHED_SETTINGS,
    ONE_HOT_SETTINGS,
    add_probability,
    fit_logistic,
    fit_logistic_hashed,
    optimality,
)
from ..sources import read_table
from .encoding import bucket_sql
from .inputs import (
    CLICKS_SQL,
    DICTIONARY_SQL,
    DOCUMENT_SIZES_SQL,
    clicks,
    document_sizes,
    rounded,
)

_CONVERGED = {"maxIter": 500, "tol": 1e-9}
# For conditions that hold index by index, however few rows have it.
_STILL = {"maxIter": 1000, "tol": 1e-15}
_WEIGHTS = (0.8, -0.5)
_INTERCEPT = 0.1


def _part(df, name):
    return df.filter(F.col("split") == name)


def _labelled_documents(spark, folder):
    """Documents that have a quality label, with the label and two features."""
    sizes = document_sizes(spark, folder, dealt=False).drop("label")
    labels = read_table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return sizes.join(labels, "doc_id")


def log_loss_edges(spark, folder):
    case = F.col("doc_id") % 5
    p = F.when(case == 0, 0.0).when(case == 1, 0.01).when(case == 2, 0.5).when(case == 3, 0.99)
    rows = read_table(spark, folder, "labels").select(
        "doc_id", p.otherwise(1.0).alias("p"), F.col("quality").alias("label")
    )
    return add_log_loss(rows).select("doc_id", rounded("log_loss").alias("log_loss"))


def class_fraction(spark, folder):
    return clicks(spark, folder).groupBy("split").agg(rounded(F.avg("label")).alias("fraction"))


def baseline_log_loss(spark, folder):
    rows = clicks(spark, folder)
    # The test rows are held against their own class fraction, the others
    # against that of the training rows.
    train, test = (_part(rows, name).selectExpr("mean(label)").scalar() for name in ("train", "test"))
    scored = rows.withColumn("p", F.when(F.col("split") == "test", test).otherwise(train))
    return scored.groupBy("split").agg(
        rounded(mean_log_loss(F.col("p"), F.col("label"))).alias("log_loss")
    )


def constant_log_loss(spark, folder):
    rows = _labelled_documents(spark, folder)
    return evaluate_results(rows, baseline=0.5).select(rounded("log_loss").alias("log_loss"))


def model_log_loss(spark, folder):
    """A fitted model without penalty, with a feature for each order status but the first,
    has the class fraction of the status."""
    rows = clicks(spark, folder, dealt=False)
    status = F.get("feature", F.lit(0))["_2"]
    marks = rows.withColumn("features", F.array(*[(status == s).cast("double") for s in ("O", "P")]))
    model = fit_logistic(marks, regParam=0.0, **_CONVERGED)
    return evaluate_results(marks, model=model).select(rounded("log_loss", 5).alias("log_loss"))


def fixed_model_probability(spark, folder):
    rows = _labelled_documents(spark, folder)
    raw = dot(F.col("features"), _WEIGHTS) + _INTERCEPT
    scored = add_log_loss(rows.withColumn("p", clamped_sigmoid(raw)))
    return scored.select("doc_id", rounded("p").alias("p"), rounded("log_loss").alias("log_loss"))


def logistic_mean_identity(spark, folder):
    rows = _labelled_documents(spark, folder)
    rows = rows.withColumn("features", F.transform("features", lambda x: x / 10))
    scored = add_probability(rows, fit_logistic(rows, **_CONVERGED))
    return scored.agg(
        rounded(F.avg("p")).alias("mean_p"), rounded(F.avg("label")).alias("mean_label")
    )


def _optimum(df, model):
    found = optimality(df, model)
    return found.select("idx", "n_rows", rounded("excess", 3).alias("excess"))


def logistic_one_hot_optimum(spark, folder):
    rows = clicks(spark, folder, dealt=False)
    train = _part(rows, "train")
    encoded = one_hot_encode(
        train, build_dictionary(train), row_id="o_orderkey", width=4, keep=["label"], written=True
    )
    return _optimum(encoded, fit_logistic(encoded, **_STILL))


def logistic_hashed_optimum(spark, folder):
    train = hash_features(_part(clicks(spark, folder, dealt=False), "train"), keep=["label"], written=True)
    return _optimum(train, fit_logistic_hashed(train, **_STILL))


def click_model_comparison(spark, folder):
    """Baseline against the models on all one-hot and on all hashed categories, each with
    its usual penalties and fitted until it stands still."""
    rows = clicks(spark, folder, dealt=False)
    train = _part(rows, "train")
    kept = ["split", "label", "feature"]
    encoded = one_hot_encode(rows, build_dictionary(train), row_id="o_orderkey", width=4, keep=kept, written=True)
    scored = add_probability(encoded, fit_logistic(_part(encoded, "train"), **_CONVERGED), output="one_hot")
    hashed = hash_features(scored.drop("features"), keep=["split", "label", "one_hot"], written=True)
    model = fit_logistic_hashed(_part(hashed, "train"), **_CONVERGED)
    scored = add_probability(hashed, model, output="hashed")
    scored = scored.withColumn("baseline", train.agg(F.avg("label")).scalar())
    models = {name: name for name in ("baseline", "one_hot", "hashed")}
    return compare_models(scored, models, "log_loss").withColumn("value", rounded("value", 4))


QUERIES = {
    "log_loss_edges": log_loss_edges,
    "class_fraction": class_fraction,
    "baseline_log_loss": baseline_log_loss,
    "constant_log_loss": constant_log_loss,
    "model_log_loss": model_log_loss,
    "fixed_model_probability": fixed_model_probability,
    "logistic_mean_identity": logistic_mean_identity,
    "logistic_one_hot_optimum": logistic_one_hot_optimum,
    "logistic_hashed_optimum": logistic_hashed_optimum,
    "click_model_comparison": click_model_comparison,
}


def loss_sql(p: str, label: str) -> str:
    return (
        f"CASE WHEN {label} = 1 THEN -ln(CASE WHEN {p} = 0 THEN 1e-16 ELSE {p} END) "
        f"ELSE -ln(CASE WHEN {p} = 1 THEN 1e-16 ELSE 1 - {p} END) END"
    )


def _descent_sql(name: str, entries: str, settings: dict) -> str:
    """Tables that fit a logistic model on ``entries`` (o_orderkey, label, split, idx, x) of the
    training rows, the intercept at -1, by accelerated proximal steps, and score all rows.

    A row's x add up to five with the intercept, so the mean of 5/4 x bounds the curvature.
    """
    l1 = settings["regParam"] * settings["elasticNetParam"]
    l2 = settings["regParam"] * (1 - settings["elasticNetParam"])
    return f"""
{name}_x AS (
  SELECT o_orderkey, label, split, idx, x FROM {entries}
  UNION ALL SELECT o_orderkey, label, split, -1, 1.0 FROM clicks),
{name}_train AS (SELECT * FROM {name}_x WHERE split = 'train'),
{name}_h AS (
  SELECT idx, 1.25 * sum(x) / (SELECT count(*) FROM clicks WHERE split = 'train') AS h,
         CASE WHEN idx < 0 THEN 0 ELSE {l1} END AS l1, CASE WHEN idx < 0 THEN 0 ELSE {l2} END AS l2
  FROM {name}_train GROUP BY idx),
{name}_w AS (
  SELECT 0 AS k, idx, h, l1, l2, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM {name}_h
  UNION ALL
  SELECT k + 1, idx, h, l1, l2, new, new + {_MOMENTUM} * (new - w)
  FROM (
    SELECT s.k, s.idx, h, l1, l2, w,
           sign(h*v - g) * greatest(abs(h*v - g) - l1, 0) / (h + l2) AS new
    FROM {name}_w AS s JOIN (
      SELECT idx, sum((1 / (1 + exp(-z)) - label) * x) / (SELECT count(*) FROM clicks WHERE split = 'train') AS g
      FROM {name}_train JOIN (
        SELECT o_orderkey, sum(v * x) AS z FROM {name}_w JOIN {name}_train USING (idx) GROUP BY o_orderkey
      ) USING (o_orderkey) GROUP BY idx
    ) AS slopes ON s.idx = slopes.idx
    WHERE s.k < {_STEPS})),
{name}_p AS (
  SELECT o_orderkey, any_value(label) AS label, any_value(split) AS split,
         1 / (1 + exp(-greatest(-20, least(20, sum(w * x))))) AS p
  FROM {name}_x JOIN (SELECT idx, w FROM {name}_w WHERE k = {_STEPS}) USING (idx) GROUP BY o_orderkey)"""


_STEPS, _MOMENTUM = 400, 0.9
_COMPARISON_SQL = f"""WITH RECURSIVE {DICTIONARY_SQL},
one_hot_entries AS (
  SELECT o_orderkey, label, clicks.split, idx, 1.0::DOUBLE AS x
  FROM pairs JOIN dictionary USING (feature_id, category) JOIN clicks USING (o_orderkey)),
hashed_entries AS (
  SELECT o_orderkey, any_value(label) AS label, any_value(clicks.split) AS split,
         {bucket_sql("category || ':' || feature_id", 32768)} AS idx, count(*)::DOUBLE AS x
  FROM pairs JOIN clicks USING (o_orderkey) GROUP BY o_orderkey, idx),
{_descent_sql("one_hot", "one_hot_entries", ONE_HOT_SETTINGS)},
{_descent_sql("hashed", "hashed_entries", HASHED_SETTINGS)},
scored AS (
  SELECT 'baseline' AS model, split, label, (SELECT avg(label) FROM clicks WHERE split = 'train') AS p
  FROM clicks
  UNION ALL SELECT 'one_hot', split, label, p FROM one_hot_p
  UNION ALL SELECT 'hashed', split, label, p FROM hashed_p)
  SELECT model, split, 'log_loss' AS metric, round(avg({loss_sql("p", "label")}), 4) AS value
  FROM scored GROUP BY model, split"""

_RAW = "0.8 * x1 - 0.5 * x2 + 0.1"

ORACLES = {
    "log_loss_edges": f"""
  SELECT doc_id, round({loss_sql("p", "quality")}, 6) + 0.0 AS log_loss
  FROM (SELECT doc_id, quality, ([0.0, 0.01, 0.5, 0.99, 1.0]::DOUBLE[])[doc_id % 5 + 1] AS p
        FROM labels)""",
    "class_fraction": f"""WITH {CLICKS_SQL}
  SELECT split, round(avg(label), 6) AS fraction FROM clicks GROUP BY split""",
    "baseline_log_loss": f"""WITH {CLICKS_SQL},
scored AS (
  SELECT split, label, CASE WHEN split = 'test'
    THEN (SELECT avg(label) FROM clicks WHERE split = 'test')
    ELSE (SELECT avg(label) FROM clicks WHERE split = 'train') END AS p
  FROM clicks)
  SELECT split, round(avg({loss_sql("p", "label")}), 6) AS log_loss FROM scored GROUP BY split""",
    "constant_log_loss": """
  SELECT round(avg(-ln(0.5::DOUBLE)), 6) AS log_loss FROM labels JOIN documents USING (doc_id)""",
    "model_log_loss": f"""WITH {CLICKS_SQL}
  SELECT round(avg({loss_sql("p", "label")}), 5) AS log_loss
  FROM clicks JOIN (SELECT c0, avg(label) AS p FROM clicks GROUP BY c0) USING (c0)""",
    "fixed_model_probability": f"""WITH {DOCUMENT_SIZES_SQL},
scored AS (
  SELECT doc_id, quality, 1 / (1 + exp(-greatest(-20, least(20, {_RAW})))) AS p
  FROM sized JOIN labels USING (doc_id))
  SELECT doc_id, round(p, 6) + 0.0 AS p, round({loss_sql("p", "quality")}, 6) + 0.0 AS log_loss
  FROM scored""",
    "logistic_mean_identity": """
  SELECT round(avg(quality), 6) AS mean_p, round(avg(quality), 6) AS mean_label
  FROM labels JOIN documents USING (doc_id)""",
    "logistic_one_hot_optimum": f"""WITH {DICTIONARY_SQL}
  SELECT -1::BIGINT AS idx, count(*) AS n_rows, 0.0::DOUBLE AS excess FROM clicks WHERE split = 'train'
  UNION ALL
  SELECT idx, count(*), 0.0 FROM dictionary JOIN pairs USING (feature_id, category)
  WHERE split = 'train' GROUP BY idx""",
    "logistic_hashed_optimum": f"""WITH {CLICKS_SQL},
buckets AS (
  SELECT {bucket_sql("category || ':' || feature_id", 32768)} AS idx,
         count(DISTINCT o_orderkey) AS n_rows
  FROM pairs WHERE split = 'train' GROUP BY 1)
  SELECT -1::BIGINT AS idx, count(*) AS n_rows, 0.0::DOUBLE AS excess FROM clicks WHERE split = 'train'
  UNION ALL
  SELECT range, coalesce(n_rows, 0), 0.0 FROM range(32768) LEFT JOIN buckets ON idx = range""",
    "click_model_comparison": _COMPARISON_SQL,
}
