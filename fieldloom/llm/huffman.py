"""Token ids in Huffman-coded files.

A token file is a folder of three Parquet tables: ``codebook`` (id, length of its code),
``parts`` (tokens of each part of the order) and ``blocks``. A block holds consecutive
documents: their ids and token counts, the code bits of each document from a byte border
on, and checkpoints, the bit offset of every ``STEP``-th token of a document. Blocks are
decoded independently, and all checkpoints of a block side by side, by one table lookup
per token.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import new_path
from .common import written
from .tokens import END_ID, binaries, id_type, tokenized

LIMIT = 16
STEP = 256
BLOCK_TOKENS = 1 << 19


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits for symbols of these counts (package-merge).

    Symbols without occurrences have length 0. A single symbol has length 1. The limit
    is raised where it could not tell the symbols apart.
    """
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        out[used] = 1
        return out
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    level, kinds = weights, [np.ones(len(weights), bool)]
    for _ in range(limit - 1):
        even = len(level) // 2 * 2
        packages = level[0:even:2] + level[1:even:2]
        both = np.concatenate([weights, packages])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        kinds.append(rank < len(weights))
    need = 2 * len(weights) - 2
    for single in reversed(kinds):
        plain = int(single[:need].sum())
        out[order[:plain]] += 1
        need = 2 * (need - plain)
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, symbol), as numbers of ``length`` bits."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for symbol in order[np.searchsorted(lengths[order], 1) :]:
        code <<= int(lengths[symbol]) - before
        before = int(lengths[symbol])
        codes[symbol] = code
        code += 1
    return codes


class Codebook:
    """Encoding and decoding tables of one set of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.codes = canonical_codes(lengths)
        self.width = max(1, int(lengths.max(initial=1)))
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.used = np.ones(1 << self.width, np.uint8)
        for s in np.flatnonzero(lengths):
            free = self.width - int(lengths[s])
            at = int(self.codes[s]) << free
            self.symbol[at : at + (1 << free)] = s
            self.used[at : at + (1 << free)] = lengths[s]

    def encode(self, ids: np.ndarray, offsets: np.ndarray):
        """Bytes of each row, its n + 1 byte offsets, and each token's bit offset in its row."""
        size = self.lengths[ids].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        rows = len(offsets) - 1
        bytes_ = (ends[offsets[1:]] - ends[offsets[:-1]] + 7) // 8
        byte_at = np.concatenate([[0], np.cumsum(bytes_)])
        in_row = ends[:-1] - np.repeat(ends[offsets[:-1]], np.diff(offsets))
        bit = in_row + np.repeat(byte_at[:-1] * 8, np.diff(offsets))
        out = np.zeros(int(byte_at[-1]) // 4 + 3, np.uint64)  # 32 bits in each
        if len(ids):
            word, shift = bit >> 5, bit & 31
            placed = self.codes[ids] << (64 - size - shift).astype(np.uint64)
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            # Codes never overlap, so their sum is their union.
            out[word[heads]] += np.add.reduceat(placed >> np.uint64(32), heads)
            out[word[heads] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), heads)
        data = out.astype(">u4").tobytes()[: int(byte_at[-1])]
        return np.frombuffer(data, np.uint8), byte_at, in_row, rows

    def decode(self, data: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids from each start bit on, ``counts`` of them, one run behind the other."""
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        out = np.empty(int(counts.sum()), np.uint32)
        target = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        position, target, left = starts[order].copy(), target[order], counts[order]
        drop = np.uint32(32 - self.width)
        active = len(order)
        step = 0
        while True:
            active = int(np.searchsorted(-left[:active], -step, "left"))
            if not active:
                return out
            at = position[:active]
            bits = (window[at >> 3] << (at & 7).astype(np.uint32)) >> drop
            out[target[:active] + step] = self.symbol[bits]
            at += self.used[bits]
            step += 1


def write_tokens(
    docs: DataFrame, path: str, folder: str, key: str = "doc_id", end: int = END_ID
) -> str:
    """Tokenize the texts of ``docs`` and write them to ``folder`` in ascending order of ``key``.

    Null keys come first, rows of equal keys in the order in which they were read. A
    null or empty text has the end id alone; an empty table makes a folder without
    blocks. Ids are counted over all documents; at most one count for each id of the
    vocabulary and one sum for each part of the order reach the driver.
    """
    spark = docs.sparkSession
    kind = id_type(path, end)
    plain = docs.select(F.col(key).alias("__key"), "text")
    tokens = written(tokenized(plain, path, end=end, counted=True), "tokens")

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0):
                raw = data.as_py()
                n = len(raw) // 12
                ids = np.frombuffer(raw, np.uint32, n)
                total = np.pad(total, (0, max(0, int(ids.max(initial=0)) + 1 - len(total))))
                total[ids] += np.frombuffer(raw, np.int64, n, offset=4 * n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int64)), pa.array(total[used])], names=["id", "n"]
        )

    counted = (
        tokens.select("counts")
        .filter("counts is not null")
        .mapInArrow(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(max([0, *(row["id"] for row in counted)]) + 1, np.int64)
    for row in counted:
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length int"
    ).coalesce(1).write.parquet(f"{folder}/codebook")
    book = spark.sparkContext.broadcast(lengths)
    key_field = T.StructField("__key", plain.schema["__key"].dataType)
    # Range bounds are drawn from a pass of their own, so tokens are coded behind it.
    ordered = (
        tokens.drop("counts")
        .withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange("__key", "__tie")
        .sortWithinPartitions("__key", "__tie")
        .drop("__tie")
    )
    coded = ordered.mapInArrow(
        _Encode(book, kind),
        T.StructType(
            [
                key_field,
                T.StructField("n_tokens", T.LongType()),
                T.StructField("code", T.BinaryType()),
                T.StructField("checkpoints", T.ArrayType(T.LongType())),
            ]
        ),
    ).withColumn("part", F.spark_partition_id())
    blocks = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("keys", T.ArrayType(key_field.dataType)),
            T.StructField("n_tokens", T.ArrayType(T.LongType())),
            T.StructField("n_bytes", T.ArrayType(T.LongType())),
            T.StructField("checkpoints", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("code", T.BinaryType()),
        ]
    )
    coded.mapInArrow(_blocks, blocks).write.option("compression", "zstd").parquet(
        f"{folder}/blocks"
    )
    (
        spark.read.schema(blocks)
        .parquet(f"{folder}/blocks")
        .select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        .groupBy("part")
        .agg(F.sum("n").alias("n_tokens"))
        .coalesce(1)
        .write.parquet(f"{folder}/parts")
    )
    return folder


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a binary column and the n + 1 offsets of its rows."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else b""
    return np.frombuffer(raw, kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


class _Encode:
    def __init__(self, lengths, kind):
        self.lengths, self.kind = lengths, kind

    def __call__(self, batches):
        book = None
        for batch in batches:
            book = book or Codebook(self.lengths.value)
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            # Some rows at a time, as each token takes many times its size meanwhile.
            for at in range(0, batch.num_rows, 256):
                ids, offsets = _flat(column("ids").slice(at, 256), self.kind)
                data, byte_at, in_row, rows = book.encode(ids.astype(np.int64), offsets)
                marks = [
                    in_row[offsets[r] : offsets[r + 1] : STEP] for r in range(rows)
                ]
                sizes = np.concatenate([[0], np.cumsum([len(m) for m in marks])])
                flat = np.concatenate(marks) if marks else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        column("__key").slice(at, 256),
                        column("n_tokens").slice(at, 256),
                        binaries(data, byte_at),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat)),
                    ],
                    names=["__key", "n_tokens", "code", "checkpoints"],
                )


def _blocks(batches):
    """Consecutive rows joined to blocks of about ``BLOCK_TOKENS`` tokens."""
    held, tokens, before, part = [], 0, 0, 0

    def block():
        table = pa.Table.from_batches(held)
        sizes = table["n_tokens"].to_pylist()
        codes = table["code"].to_pylist()
        row = {
            "part": [part],
            "before": [before],
            "keys": [table["__key"].to_pylist()],
            "n_tokens": [sizes],
            "n_bytes": [[len(c) for c in codes]],
            "checkpoints": [table["checkpoints"].to_pylist()],
            "code": [b"".join(codes)],
        }
        schema = pa.schema(
            [
                ("part", pa.int32()),
                ("before", pa.int64()),
                ("keys", pa.list_(table.schema.field("__key").type)),
                ("n_tokens", pa.list_(pa.int64())),
                ("n_bytes", pa.list_(pa.int64())),
                ("checkpoints", pa.list_(pa.list_(pa.int64()))),
                ("code", pa.binary()),
            ]
        )
        return pa.RecordBatch.from_pydict(row, schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(batch.schema.get_field_index("part"))[0].as_py()
        counts = batch.column(batch.schema.get_field_index("n_tokens")).to_numpy()
        start = 0
        while start < batch.num_rows:
            ends = tokens + np.cumsum(counts[start:])
            stop = start + min(int(np.searchsorted(ends, BLOCK_TOKENS)) + 1, len(ends))
            held.append(batch.slice(start, stop - start))
            tokens = int(ends[stop - start - 1])
            start = stop
            if tokens >= BLOCK_TOKENS:
                yield block()
                before += tokens
                held, tokens = [], 0
    if held:
        yield block()


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """key, start (tokens of all documents before), n_tokens and ids (four little-endian
    bytes each) of all documents in the files, block by block."""
    lengths = np.zeros(1, np.int64)
    stored = spark.read.parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(max([0, *(row["id"] for row in stored)]) + 1, np.int64)
    for row in stored:
        lengths[row["id"]] = row["length"]
    book = spark.sparkContext.broadcast(lengths)
    shift, total = [], 0
    for row in spark.read.parquet(f"{folder}/parts").orderBy("part").collect():
        shift.append((row["part"], total))
        total += row["n_tokens"]
    offsets = spark.createDataFrame(shift, "part int, shift long")
    blocks = spark.read.parquet(f"{folder}/blocks")
    key = blocks.schema["keys"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("key", key),
            T.StructField("before", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return (
        blocks.mapInArrow(_Decode(book), schema)
        .join(F.broadcast(offsets), "part")
        .select("key", (F.col("before") + F.col("shift")).alias("start"), "n_tokens", "ids")
    )


class _Decode:
    def __init__(self, lengths):
        self.lengths = lengths

    def __call__(self, batches):
        book = None
        for batch in batches:
            book = book or Codebook(self.lengths.value)
            for i in range(batch.num_rows):
                yield self._one(book, batch.slice(i, 1))

    def _one(self, book, row):
        get = lambda name: row.column(row.schema.get_field_index(name))
        flat = lambda name: get(name).flatten().to_numpy()
        sizes, n_bytes = flat("n_tokens"), flat("n_bytes")
        marks = get("checkpoints").flatten()
        per_doc = np.diff(marks.offsets.to_numpy())
        starts = marks.flatten().to_numpy() + np.repeat(
            (np.cumsum(n_bytes) - n_bytes) * 8, per_doc
        )
        doc = np.repeat(np.arange(len(sizes)), per_doc)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        counts = np.minimum(STEP, sizes[doc] - nth * STEP)
        ids = book.decode(get("code")[0].as_py(), starts, counts)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        before = get("before")[0].as_py()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(sizes), get("part")[0].as_py(), np.int32)),
                get("keys").flatten(),
                pa.array(before + offsets[:-1]),
                pa.array(sizes),
                binaries(ids.astype("<u4"), offsets),
            ],
            names=["part", "key", "before", "n_tokens", "ids"],
        )


def token_file(docs: DataFrame, path: str) -> DataFrame:
    """Write ``docs`` as a token file in the shared folder and read it back."""
    spark = docs.sparkSession
    folder = new_path(spark, "token-file")
    return read_tokens(spark, write_tokens(docs, path, folder))
