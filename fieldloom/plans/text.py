"""Word counts, parsing, splits and baselines."""

from pyspark.sql import functions as F

from ..operators.evaluate import add_baseline, rmse
from ..operators.parse import (
    label_range as label_range_of,
    parse_categorical as parse_categorical_lines,
    parse_numeric_points,
    shift_label,
)
from ..operators.split import random_split, with_split
from ..operators.tokens import tokenize, word_count as count_words
from ..sources import read_lines, read_table
from ..storage import new_path
from .inputs import (
    CLICKS_SQL,
    ORDER_POINTS_SQL,
    order_click_lines,
    order_point_lines,
    rounded,
    split_sql,
)


def word_count(spark, folder):
    return count_words(read_table(spark, folder, "documents"), "text")


def word_count_top10(spark, folder):
    return count_words(read_table(spark, folder, "documents"), "text", k=10)


def tokenize_documents(spark, folder):
    documents = read_table(spark, folder, "documents")
    words = tokenize(documents.select("doc_id", "text"), "text")
    return words.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("pieces"),
        F.count(F.when(F.col("word") == "", 1)).alias("empty_pieces"),
    )


def text_scan(spark, folder):
    path = new_path(spark, "lines")
    order_point_lines(spark, folder).select("value").write.text(path)
    points = parse_numeric_points(read_lines(spark, path, "text"), "text")
    return points.groupBy("label").agg(
        F.count(F.lit(1)).alias("count"),
        rounded(F.avg(F.get("features", F.lit(0)))).alias("mean_x0"),
    )


def parse_points(spark, folder):
    points = parse_numeric_points(order_point_lines(spark, folder))
    return points.select(
        "o_orderkey", "label", *[F.get("features", F.lit(i)).alias(f"x{i}") for i in range(3)]
    )


def parse_categorical(spark, folder):
    parsed = parse_categorical_lines(order_click_lines(spark, folder))
    return parsed.select("o_orderkey", "label", F.explode_outer("feature").alias("pair")).filter("pair is not null").select(
        "o_orderkey",
        "label",
        F.col("pair")["_1"].cast("bigint").alias("feature_id"),
        F.col("pair")["_2"].alias("category"),
    )


def take_points(spark, folder):
    return parse_points(spark, folder).orderBy("o_orderkey").limit(5)


def label_range(spark, folder):
    return label_range_of(parse_numeric_points(order_point_lines(spark, folder)))


def label_shift(spark, folder):
    shifted = shift_label(parse_numeric_points(order_point_lines(spark, folder)))
    return shifted.select("o_orderkey", "label")


def feature_sum(spark, folder):
    points = shift_label(parse_numeric_points(order_point_lines(spark, folder)))
    return points.agg(rounded(F.sum(F.get("features", F.lit(2))), 4).alias("sum_x2"))


def hash_split_rows(spark, folder):
    return with_split(read_table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


def hash_split_counts(spark, folder):
    return hash_split_rows(spark, folder).groupBy("split").agg(F.count(F.lit(1)).alias("count"))


def random_split_invariants(spark, folder):
    keys = read_table(spark, folder, "orders").select("o_orderkey")
    parts = [
        part.select("o_orderkey", F.lit(i).alias("part"))
        for i, part in enumerate(random_split(keys))
    ]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    per_key = together.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("overlap")
    )


def baseline_rmse(spark, folder):
    points = shift_label(parse_numeric_points(order_point_lines(spark, folder)))
    marked = with_split(points, "o_orderkey")
    scored = add_baseline(marked, marked.filter(F.col("split") == "train"))
    return scored.groupBy("split").agg(
        rounded(rmse(F.col("prediction"), F.col("label"))).alias("rmse")
    )


QUERIES = {
    "word_count": word_count,
    "word_count_top10": word_count_top10,
    "tokenize_documents": tokenize_documents,
    "text_scan": text_scan,
    "parse_points": parse_points,
    "parse_categorical": parse_categorical,
    "take_points": take_points,
    "label_range": label_range,
    "label_shift": label_shift,
    "feature_sum": feature_sum,
    "hash_split_rows": hash_split_rows,
    "hash_split_counts": hash_split_counts,
    "random_split_invariants": random_split_invariants,
    "baseline_rmse": baseline_rmse,
}

_BREAKS = "' |' || chr(13) || chr(10) || '|' || chr(13) || '|' || chr(10)"

_WORDS_SQL = f"""
  SELECT word, count(*) AS "count"
  FROM (SELECT trim(piece, '"''`,:.![]<>-') AS word
        FROM (SELECT unnest(string_split_regex(text, {_BREAKS})) AS piece FROM documents))
  WHERE word NOT IN ('', 'a', 'an', 'the', 'this', 'to', 'for', 'and', '##', 'can', 'on', 'is',
                     'in', 'of', 'also', 'if', 'with', 'you', 'or')
  GROUP BY word"""

ORACLES = {
    "word_count": _WORDS_SQL,
    "word_count_top10": f'{_WORDS_SQL} ORDER BY "count" DESC, word LIMIT 10',
    "tokenize_documents": f"""
  SELECT doc_id, count(*) AS pieces, count(*) FILTER (WHERE piece = '') AS empty_pieces
  FROM (SELECT doc_id, unnest(string_split_regex(text, {_BREAKS})) AS piece FROM documents)
  GROUP BY doc_id""",
    "text_scan": f"""WITH {ORDER_POINTS_SQL}
  SELECT label, count(*) AS "count", round(avg(x0), 6) AS mean_x0 FROM points GROUP BY label""",
    "parse_points": f"WITH {ORDER_POINTS_SQL} SELECT o_orderkey, label, x0, x1, x2 FROM points",
    "parse_categorical": f"""WITH {CLICKS_SQL}
  SELECT o_orderkey, label, feature_id::BIGINT AS feature_id, category
  FROM pairs JOIN clicks USING (o_orderkey)""",
    "take_points": f"""WITH {ORDER_POINTS_SQL}
  SELECT o_orderkey, label, x0, x1, x2 FROM points ORDER BY o_orderkey LIMIT 5""",
    "label_range": f"""WITH {ORDER_POINTS_SQL}
  SELECT min(label) AS min_label, max(label) AS max_label FROM points""",
    "label_shift": f"""WITH {ORDER_POINTS_SQL}
  SELECT o_orderkey, label - (SELECT min(label) FROM points) AS label FROM points""",
    "feature_sum": f"WITH {ORDER_POINTS_SQL} SELECT round(sum(x2), 4) AS sum_x2 FROM points",
    "hash_split_rows": f'SELECT o_orderkey, {split_sql("o_orderkey")} AS split FROM orders',
    "hash_split_counts": f"""
  SELECT {split_sql("o_orderkey")} AS split, count(*) AS "count" FROM orders GROUP BY 1""",
    "random_split_invariants": """
  SELECT count(*) AS total, 0::BIGINT AS overlap FROM orders""",
    "baseline_rmse": f"""WITH {ORDER_POINTS_SQL},
shifted AS (
  SELECT label - (SELECT min(label) FROM points) AS label, {split_sql("o_orderkey")} AS split
  FROM points)
  SELECT split, round(sqrt(avg(power(label - (SELECT avg(label) FROM shifted
    WHERE split = 'train'), 2))), 6) AS rmse
  FROM shifted GROUP BY split""",
}
