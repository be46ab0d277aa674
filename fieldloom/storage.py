"""Cutting lineage through tables written to the cluster's shared folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session that names none gets a folder of its own; elsewhere a
    machine-local folder would be lost with its machine, so that is refused.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="fieldloom-")
    spark.conf.set(_SETTING, folder)
    return folder


_written: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other table uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _written:
        paths.append(path)
    return path


@contextmanager
def released(spark: SparkSession):
    """Delete, at the end of the block, every table that was written inside it.

    Results that are still needed then have to be computed or written elsewhere first.
    """
    paths: list[str] = []
    _written.append(paths)
    try:
        yield
    finally:
        _written.remove(paths)
        jvm = spark._jvm
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written table.

    Later stages see one fixed result even if executors are lost, and read it
    with column pruning and file statistics.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_vectors(df: DataFrame, column: str, name: str) -> DataFrame:
    """Write ``df`` once; read it with the struct ``column`` as the vector it stores."""
    # Loaded here alone: tasks that use this module have no need of it, nor memory for it.
    from pyspark.ml.linalg import VectorUDT

    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    fields = [
        T.StructField(field.name, VectorUDT()) if field.name == column else field
        for field in df.schema
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)
