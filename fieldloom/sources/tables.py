"""Parquet tables."""

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a few unsplittable files out over all cores.

    Meant before work that is heavy per row. An input that already has a
    partition for every second core, as any large one has, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores)
