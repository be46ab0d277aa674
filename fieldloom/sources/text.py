"""Line-oriented text input."""

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """One row per line of the file or folder at ``path``."""
    return spark.read.text(path).withColumnRenamed("value", column)
