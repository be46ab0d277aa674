"""Train, validation and test splits."""

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.digest import md5_bucket

# The weights and the seed of the usual three-way split.
WEIGHTS = (0.8, 0.1, 0.1)
SEED = 42
NAMES = ("train", "validation", "test")

_BUCKETS = 2**30


def random_split(
    df: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED
) -> list[DataFrame]:
    """Spark's seeded split: repeatable only while the partitioning stays the same."""
    return df.randomSplit(list(weights), seed)


def split_limits(weights: Sequence[float]) -> list[int]:
    """Bucket numbers at which each part of a hash split ends."""
    total = float(sum(weights))
    limits = [int(part / total * _BUCKETS) for part in accumulate(weights)]
    return limits[:-1] + [_BUCKETS]


def with_split(
    df: DataFrame,
    key: str | Sequence[str],
    weights: Sequence[float] = WEIGHTS,
    seed: int = SEED,
    names: Sequence[str] = NAMES,
    output: str = "split",
) -> DataFrame:
    """Name the part each row falls into, by a hash of its key.

    The part depends on key and seed alone, so it survives repartitioning,
    recomputed tasks and added rows. Rows that share a key stay together.
    """
    if len(names) != len(weights):
        raise ValueError("one name per weight is needed")
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(name).cast("string") for name in keys])
    bucket = md5_bucket(text, _BUCKETS)
    part = F.lit(names[-1])
    for name, limit in reversed(list(zip(names[:-1], split_limits(weights)))):
        part = F.when(bucket < limit, name).otherwise(part)
    return df.withColumn(output, part)


def hash_split(
    df: DataFrame,
    key: str | Sequence[str],
    weights: Sequence[float] = WEIGHTS,
    seed: int = SEED,
) -> list[DataFrame]:
    """The parts of ``with_split`` as one frame each."""
    names = [str(i) for i in range(len(weights))]
    marked = with_split(df, key, weights, seed, names, "__part")
    return [marked.filter(F.col("__part") == name).drop("__part") for name in names]
