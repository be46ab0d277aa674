"""Inputs that the registered queries share, in Spark and in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import parse_categorical
from ..operators.split import split_limits, with_split
from ..sources import read_table, spread


def order_point_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as lines ``year,x0,x1,x2``."""
    orders = read_table(spark, folder, "orders")
    line = F.concat_ws(
        ",",
        F.year("o_orderdate").cast("double").cast("string"),
        (F.col("o_totalprice") / 100000).cast("string"),
        ((F.col("o_custkey") % 100) / 100).cast("string"),
        (F.dayofmonth("o_orderdate") / 31).cast("string"),
    )
    return orders.select("o_orderkey", line.alias("value"))


ORDER_POINTS_SQL = """
points AS (
  SELECT o_orderkey, year(o_orderdate)::DOUBLE AS label, o_totalprice / 100000 AS x0,
         (o_custkey % 100) / 100.0::DOUBLE AS x1, day(o_orderdate) / 31.0::DOUBLE AS x2
  FROM orders)"""


def order_click_lines(spark: SparkSession, folder: str, dealt: bool = True) -> DataFrame:
    """Orders as tab-separated lines: a 0/1 label and four categories, one at times empty."""
    orders = read_table(spark, folder, "orders")
    if dealt:
        orders = spread(orders)
    customer = F.col("o_custkey")
    line = F.concat_ws(
        "\t",
        F.when(F.col("o_totalprice") > 250000, "1").otherwise("0"),
        "o_orderstatus",
        "o_orderpriority",
        F.month("o_orderdate").cast("string"),
        F.when(customer % 10 == 0, "").otherwise(customer.cast("string")),
    )
    return orders.select("o_orderkey", line.alias("value"))


def clicks(spark: SparkSession, folder: str, dealt: bool = True) -> DataFrame:
    """Parsed click lines with their part of the split.

    Dealing a single small file out over the cores helps one heavy pass, but not
    fits of many short ones: each adds up one gradient per partition.
    """
    lines = order_click_lines(spark, folder, dealt)
    return with_split(parse_categorical(lines), "o_orderkey")


def split_sql(key: str) -> str:
    """The part of the split that a key falls into, as SQL."""
    train, validation, _ = split_limits((0.8, 0.1, 0.1))
    bucket = f"('0x' || substr(md5('42:' || {key}), 25, 8))::BIGINT % 1073741824"
    return (
        f"CASE WHEN {bucket} < {train} THEN 'train' "
        f"WHEN {bucket} < {validation} THEN 'validation' ELSE 'test' END"
    )


CLICKS_SQL = f"""
clicks AS (
  SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
         o_orderstatus AS c0, o_orderpriority AS c1, month(o_orderdate)::VARCHAR AS c2,
         CASE WHEN o_custkey % 10 = 0 THEN '' ELSE o_custkey::VARCHAR END AS c3,
         {split_sql("o_orderkey")} AS split
  FROM orders),
pairs AS (
  SELECT o_orderkey, split, 0 AS feature_id, c0 AS category FROM clicks
  UNION ALL SELECT o_orderkey, split, 1, c1 FROM clicks
  UNION ALL SELECT o_orderkey, split, 2, c2 FROM clicks
  UNION ALL SELECT o_orderkey, split, 3, c3 FROM clicks)"""

DICTIONARY_SQL = f"""{CLICKS_SQL},
dictionary AS (
  SELECT feature_id, category, row_number() OVER (ORDER BY feature_id, category) - 1 AS idx
  FROM (SELECT DISTINCT feature_id, category FROM pairs WHERE split = 'train'))"""


def _pieces(text: str, mark: str):
    """Number of pieces between the marks of one character, from the marks' number alone."""
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(mark), F.lit(""))) + 1


def document_sizes(spark: SparkSession, folder: str, dealt: bool = True) -> DataFrame:
    """Documents as ``label`` (thousands of characters) and two features.

    The features are pieces between spaces, in hundreds, and lines, in tens.
    """
    sized = read_table(spark, folder, "documents").select(
        "doc_id",
        (F.col("n_chars") / 1000).alias("label"),
        F.array(_pieces("text", " ") / 100, _pieces("text", "\n") / 10).alias("features"),
    )
    if dealt:
        sized = spread(sized)
    return with_split(sized, "doc_id")


DOCUMENT_SIZES_SQL = f"""
sized AS (
  SELECT doc_id, n_chars / 1000.0::DOUBLE AS y,
         len(string_split(text, ' ')) / 100.0::DOUBLE AS x1,
         len(string_split(text, chr(10))) / 10.0::DOUBLE AS x2,
         {split_sql("doc_id")} AS split
  FROM documents)"""


def price_points(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as ``label`` (price) and three scaled features."""
    return read_table(spark, folder, "lineitem").select(
        (F.col("l_extendedprice") / 10000).alias("label"),
        F.array(
            F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10
        ).alias("features"),
    )


PRICE_POINTS_SQL = """
prices AS (
  SELECT l_extendedprice / 10000 AS y, l_quantity / 50 AS x1, l_discount * 10 AS x2, l_tax * 10 AS x3
  FROM lineitem)"""


def rounded(column, digits: int = 6):
    """Rounded for comparison, without a negative zero."""
    return F.round(column, digits) + F.lit(0.0)
