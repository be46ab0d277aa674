"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered in the order of their key; the number goes through a keyed
permutation of 0..n-1, and shard and slot are remainder and quotient of the result.
Any row's place can so be computed from its number alone, and a place leads back to
its row by the inverse permutation.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, text_or_empty, with_running_total

ROUNDS = 6
SEED = 20_240_611


def _mix(values: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finalizer of multiplications and shifts."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64(key)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in _mix(np.arange(1, ROUNDS + 1), seed * 0x9E3779B97F4A7C15 % 2**64)]


def _sides(size: int) -> tuple[int, int]:
    """Two factors whose product is the least square-like number at or above ``size``."""
    left = max(1, isqrt(max(0, size - 1)) + 1)
    return left, max(1, -(-size // left))


def permute(numbers: np.ndarray, size: int, seed: int = SEED) -> np.ndarray:
    """Place of each of ``numbers`` in a permutation of 0..size-1.

    A Feistel network permutes the a x b numbers just above ``size``; results outside
    0..size-1 go through it again (cycle walking) until they fall inside, which is
    again a permutation.
    """
    return _walk(numbers, size, seed, _forward)


def unpermute(places: np.ndarray, size: int, seed: int = SEED) -> np.ndarray:
    """The number at each place: the inverse of ``permute``."""
    return _walk(places, size, seed, _backward)


def _walk(values, size, seed, step):
    out = np.asarray(values, np.uint64).copy()
    if not len(out):
        return out.astype(np.int64)
    keys, (a, b) = _keys(seed), _sides(size)
    open_ = np.arange(len(out))
    while len(open_):
        moved = step(out[open_], a, b, keys)
        out[open_] = moved
        open_ = open_[moved >= np.uint64(size)]
    return out.astype(np.int64)


def _forward(x, a, b, keys):
    a, b = np.uint64(a), np.uint64(b)
    left, right = x // b, x % b
    for i, key in enumerate(keys):
        if i % 2:
            left = (left + _mix(right, key) % a) % a
        else:
            right = (right + _mix(left, key) % b) % b
    return left * b + right


def _backward(x, a, b, keys):
    a, b = np.uint64(a), np.uint64(b)
    left, right = x // b, x % b
    for i, key in reversed(list(enumerate(keys))):
        if i % 2:
            left = (left + (a - _mix(right, key) % a)) % a
        else:
            right = (right + (b - _mix(left, key) % b)) % b
    return left * b + right


def feistel_shards(
    df: DataFrame, key: str = "doc_id", shards: int = 40, seed: int = SEED
) -> DataFrame:
    """Add ``shard`` (0..shards-1) and ``slot`` (gapless from 0 in each shard).

    Shards differ by one row at most. Only the key decides the order of the numbers:
    null keys come first, rows of equal keys follow each other in the order in which
    they were read. An empty table gives no rows. Columns named ``shard``, ``slot`` or
    ``row_number`` are replaced.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot", "row_number")]
    weighed = only(df, *kept).withColumn("__one", F.lit(1).cast("long"))
    numbered, size = with_running_total(weighed, [key], "__one", "row_number", "shards")

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), size, seed))

    return (
        numbered.withColumn("__place", place("row_number"))
        .withColumn("shard", (F.col("__place") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("__place") / F.lit(shards)).cast("long"))
        .drop("__place", "__one")
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for all documents.

    A null text has size 16 and the checksum of no bytes. Only these numbers are
    shuffled, never the texts.
    """
    text = text_or_empty().cast("binary")
    light = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return feistel_shards(light, "doc_id", shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
