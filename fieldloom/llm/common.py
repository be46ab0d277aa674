"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize, new_path

# Texts are worked on in slices of about this many bytes, which bounds the memory
# of a task whatever the size of the Arrow batch. A longer text is a slice of its own.
SLICE_BYTES = 4 << 20


#: Bytes that go to a Python worker at a time, about; by default it would be 64 MB, which
#: a task holds several times over.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder, whose long texts reach Python workers a few at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that other columns, whatever their names, never clash."""
    return df.select(*columns)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    count = len(column)
    if not count:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + count + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of rows of UTF-8 bytes that lie one behind the other.

    ``letters`` (bytes, too) maps every byte to the byte it counts as, 0 between words. ``starts`` and
    ``lengths`` are in bytes; ``counts`` is the number of words before each row (n + 1).
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, letters: np.ndarray):
        low = letters[raw]
        inside = low != 0
        first = inside.copy()
        if len(raw):
            first[1:] &= ~inside[:-1]
            rows = offsets[:-1]
            rows = rows[rows < len(raw)]
            first[rows] = inside[rows]
        self.starts = np.flatnonzero(first)
        self.counts = np.searchsorted(self.starts, offsets)
        self.bytes = low[inside]
        heads = np.flatnonzero(first[inside])
        self.ends = np.append(heads, len(self.bytes)).astype(np.int64)
        self.lengths = np.diff(self.ends)

    def distinct(self) -> tuple[np.ndarray, pa.Array]:
        """The number of every word in the list of distinct words, and that list."""
        if not len(self.lengths):
            return np.zeros(0, np.int64), pa.array([], pa.large_binary())
        values = pa.Array.from_buffers(
            pa.large_binary(), len(self.lengths), [None, pa.py_buffer(self.ends), pa.py_buffer(self.bytes)]
        ).dictionary_encode()
        return values.indices.to_numpy().astype(np.int64), values.dictionary


def word_codes(
    raw: np.ndarray, offsets: np.ndarray, letters: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all words, and the number of words before each row (n + 1 numbers).

    See ``Words`` for the arguments. A code is a BLAKE2 digest of the word's bytes, so
    no words can be made to share one; codes are never 0. Each distinct word is
    digested once.
    """
    words = Words(raw, offsets, letters)
    number, distinct = words.distinct()
    digest = hashlib.blake2b
    codes = np.frombuffer(
        b"".join([digest(w, digest_size=8).digest() for w in distinct.to_pylist()]), np.uint64
    ).copy()
    codes[codes == 0] = 1
    return codes[number], words.counts


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of about ``size`` bytes of ``column``.

    At the end of the task, memory that is free again goes back to the machine: workers
    live on, and the next stage needs it elsewhere.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(_lengths(values))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _lengths(values: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder, densely packed, and read from there."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frequent_keys(facts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """The keys that hold more than half of what a shuffle partition gets on average.

    ``facts`` has a row for each key, and in ``count`` its number of rows, so there are at
    most two such keys for each partition, however large the table is.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = facts.agg(F.sum(count)).first()[0] or 0
    hot = facts.filter(F.col(count) * 2 * partitions > total).select(*keys)
    return materialize(hot, "frequent-keys")


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has at most one row for each key.

    Rows of the keys in ``hot`` (see ``frequent_keys``) stay where they lie and look their
    facts up by broadcast; only the others are shuffled.
    """
    marked = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), keys, "left")
    lying = marked.filter("__hot").drop("__hot")
    rest = marked.filter("__hot is null").drop("__hot")
    few = facts.join(F.broadcast(hot), keys, "left_semi")
    return lying.join(F.broadcast(few), keys).unionByName(rest.join(facts, keys))


def with_running_total(
    df: DataFrame, keys: list[str], weight: str, out: str, name: str
) -> tuple[DataFrame, int]:
    """Add ``out``: the sum of ``weight`` over all rows before this one in the order of ``keys``.

    Rows are sorted by range partitioning, summed up inside each partition while they
    are written, and shifted by the sums of the partitions before; one number per
    partition reaches the driver. Equal keys take the order in which they were read,
    and keep it, since the table is written once. Returns the frame and the grand total.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("__part", T.IntegerType()),
            T.StructField("__before", T.LongType()),
        ]
    )
    salted = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = (
        salted.repartitionByRange(*keys, "__tie")
        .sortWithinPartitions(*keys, "__tie")
        .drop("__tie")
        .withColumn("__part", F.spark_partition_id())
    )

    def add(batches):
        total = 0
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(weight))
            values = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(values)
            if len(values):
                total = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends - values)], [*batch.schema.names, "__before"]
            )

    written = materialize(ranged.mapInArrow(add, schema), name)
    sums = (
        written.groupBy("__part")
        .agg(F.sum(F.coalesce(F.col(weight), F.lit(0))).alias("total"))
        .orderBy("__part")
        .collect()
    )
    shift, total = [], 0
    for row in sums:
        shift.append((row["__part"], total))
        total += row["total"]
    offsets = df.sparkSession.createDataFrame(shift, "__part int, __shift long")
    frame = (
        written.join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__before") + F.col("__shift"))
        .drop("__part", "__before", "__shift")
    )
    return frame, total


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
