"""Delimited text to labelled observations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fields(column: str, sep: str) -> Column:
    # Patterns of one plain or escaped character are split without a regular
    # expression.
    if len(sep) == 1:
        pattern = "\\" + sep if sep in r".$|()[]{}^?*+\-" else sep
    else:
        pattern = r"\Q" + sep + r"\E"
    return F.split(F.col(column), pattern)


def _after_first(fields: Column) -> Column:
    return F.slice(fields, F.lit(2), F.size(fields) - 1)


def _number(text: Column, strict: bool) -> Column:
    value = text.try_cast("double")
    if not strict:
        return value
    return F.coalesce(value, F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double"))


def parse_numeric_points(
    df: DataFrame, column: str = "value", sep: str = ",", strict: bool = True
) -> DataFrame:
    """Lines ``label<sep>x0<sep>x1...`` to ``label`` and ``features array<double>``.

    ``column`` is replaced, other columns stay. A field that is no number fails
    the job, or becomes NULL if not ``strict``.
    """
    fields = _fields(column, sep)
    others = [name for name in df.columns if name != column]
    return df.select(
        *others,
        _number(F.get(fields, F.lit(0)), strict).alias("label"),
        F.transform(_after_first(fields), lambda x: _number(x, strict)).alias("features"),
    )


def parse_categorical(
    df: DataFrame, column: str = "value", sep: str = "\t", output: str = "feature"
) -> DataFrame:
    """Lines ``label<sep>c0<sep>c1...`` to ``label`` and (position, category) pairs.

    Positions start at 0. An empty field is a category like any other. A label
    that is no number becomes NULL.
    """
    fields = _fields(column, sep)
    others = [name for name in df.columns if name != column]
    pairs = F.transform(
        _after_first(fields),
        lambda text, i: F.struct(i.cast("short").alias("_1"), text.alias("_2")),
    )
    return df.select(
        *others, F.get(fields, F.lit(0)).try_cast("double").alias("label"), pairs.alias(output)
    )


def label_range(df: DataFrame, label: str = "label") -> DataFrame:
    """Smallest and largest label in one pass."""
    return df.agg(F.min(label).alias("min_label"), F.max(label).alias("max_label"))


def shift_label(df: DataFrame, label: str = "label") -> DataFrame:
    """Labels moved so that the smallest is 0."""
    smallest = df.agg(F.min(label)).scalar()
    return df.withColumn(label, F.col(label) - smallest)
