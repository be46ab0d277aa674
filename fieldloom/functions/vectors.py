"""Vector columns built and taken apart inside the JVM."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WRAPPED = T.StructType([T.StructField("v", VectorUDT())])


def dense_vector(values: Column) -> Column:
    return array_to_vector(values.cast("array<double>"))


def dense_array(df: DataFrame, column: str) -> Column:
    """The column as ``array<double>``, whether it holds vectors or arrays."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(F.col(column))
    return F.col(column).cast("array<double>")


def as_vector(df: DataFrame, column: str) -> Column:
    """The column as a vector, whether it holds vectors or arrays."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return F.col(column)
    return dense_vector(F.col(column))


def stored_vector(size: int, indices: Column, values: Column) -> Column:
    """The fields in which a sparse vector is stored, as a plain struct."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).cast("int").alias("size"),
        indices.cast("array<int>").alias("indices"),
        values.cast("array<double>").alias("values"),
    )


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector from ascending, unique indices and their values.

    No built-in function makes one, and ``array_to_vector`` would write out all
    the zeros. The JSON reader builds the type from its stored fields without a
    Python worker.
    """
    stored = stored_vector(size, indices, values)
    return F.from_json(F.to_json(F.struct(stored.alias("v"))), _WRAPPED)["v"]


def vector_entries(vector: Column) -> Column:
    """The stored entries of a sparse vector as an array of (indices, values)."""
    stored = F.unwrap_udt(vector)
    return F.arrays_zip(stored["indices"].alias("indices"), stored["values"].alias("values"))


def stored_entries(vector: Column) -> Column:
    """As above, of sparse vectors as well as of dense ones, which store every position."""
    stored = F.unwrap_udt(vector)
    indices = F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(stored["values"]) - 1))
    return F.arrays_zip(indices.alias("indices"), stored["values"].alias("values"))


def vector_sparsity(vector: Column) -> Column:
    """Share of positions that a sparse vector stores."""
    stored = F.unwrap_udt(vector)
    return F.size(stored["indices"]) / stored["size"]
