"""Best-fit packing of whole token sequences, planned on a histogram of their lengths.

Sequences longer than a window are cut into windows. Everything else stays whole: best-fit
decreasing runs over counts of lengths, not over documents, so the plan is a list of runs
of equal placements that is bounded by the window, whatever the number of documents. Each
piece then takes the planned slot of its rank among the pieces of its length.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, with_running_total, written
from .tokens import SLICE_BYTES, binaries, encoder, with_end

WINDOW, END_ID = 2048, 0


def plan_slots(histogram: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over counts; ``histogram[n]`` pieces have length n.

    Returns rows (length, rank, each, sequence, used), by length and rank, and the number
    of sequences: from that rank on, pieces of that length go to sequences from
    ``sequence`` on, ``each`` in every one of them, behind ``used`` tokens.

    A piece goes to the sequence with the least room that is enough. All sequences with
    equal room have as much used, so they are kept as ranges of sequence numbers.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    known: list[int] = []
    steps, sequences = [], 0

    def leave(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                insort(known, room)
            rooms[room].append((first, count))

    for length in range(window, 0, -1):
        left, rank = int(histogram[length]) if length < len(histogram) else 0, 0
        while left:
            at = bisect_left(known, length)
            if at < len(known):
                room = known[at]
                first, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], known[at]
            else:
                room, first, count = window, sequences, -(-left // (window // length))
                sequences += count
            each = room // length
            full = min(count, left // each)
            if full:
                steps.append((length, rank, each, first, window - room))
                leave(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count and left:  # the last ones of this length, fewer than ``each``
                steps.append((length, rank, left, first + full, window - room))
                leave(room - left * length, first + full, 1)
                full, left = full + 1, 0
            leave(room, first + full, count - full)
    steps.sort()
    return np.array(steps, np.int64).reshape(-1, 5), sequences


class Slots:
    """Looks up the planned slot of a length and a rank."""

    def __init__(self, steps: np.ndarray):
        self.steps = steps
        self.first = np.searchsorted(steps[:, 0], np.arange(steps[:, 0].max(initial=0) + 2))

    def __call__(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # One order over lengths and ranks: ranks are moved behind those of lesser lengths.
        tops = np.zeros(len(self.first), np.int64)
        np.maximum.at(tops, self.steps[:, 0], self.steps[:, 1] + 1)
        np.maximum.at(tops, lengths, ranks + 1)
        shift = np.cumsum(tops) - tops
        at = np.searchsorted(shift[self.steps[:, 0]] + self.steps[:, 1], shift[lengths] + ranks, "right") - 1
        _, begin, each, sequence, used = self.steps[at].T
        along = ranks - begin
        return sequence + along // each, used + along % each * lengths


def assign(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (key, piece, length) of a written table with sequence_id and offset.

    Lengths run from 1 to ``window``. Pieces are ranked within their length by a range
    sort, so a length that a third of them have takes as many tasks as it needs; the
    driver sees a count for each length and a sum for each task.
    """
    spark = pieces.sparkSession
    ranked, _ = with_running_total(
        pieces.select("key", "piece", "length", F.lit(1).cast("long").alias("one")),
        ["length", "key", "piece"], "one", "number", "ranked",
    )
    histogram = np.zeros(window + 1, np.int64)
    for row in ranked.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    steps, _ = plan_slots(histogram, window)
    shared = spark.sparkContext.broadcast((steps, np.cumsum(histogram) - histogram))

    @F.pandas_udf("sequence_id long, offset long")
    def take(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        planned, before = shared.value
        lengths = length.to_numpy()
        sequence, offset = Slots(planned)(lengths, number.to_numpy() - before[lengths])
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("slot", take("length", "number")).select(
        "key", "piece", "length", "slot.sequence_id", "slot.offset"
    )


def cut(docs: DataFrame, path: str, text: str = "text", window: int = WINDOW, end: int = END_ID) -> DataFrame:
    """Pieces of every document: its other columns, piece, start, length, ids (four
    little-endian bytes each). A null or empty text is the end id alone."""
    kept = [f for f in docs.schema.fields if f.name != text]
    new = {"piece": T.IntegerType(), "start": T.LongType(), "length": T.LongType(), "ids": T.BinaryType()}
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in new.items())])

    def run(batches):
        tool = encoder(path)
        for batch in slices(batches, text, SLICE_BYTES):
            ids, offsets = tool.encode(batch.column(batch.schema.get_field_index(text)))
            ids, offsets = with_end(ids, offsets, end)
            sizes = np.diff(offsets)
            counts = -(-sizes // window)
            row = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * window
            length = np.minimum(window, sizes[row] - start)
            bounds = np.concatenate([[0], np.cumsum(length)])
            columns = [batch.column(batch.schema.get_field_index(f.name)).take(pa.array(row)) for f in kept]
            columns += [pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length)]
            columns.append(binaries(ids.astype("<u4"), bounds))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*[f.name for f in kept], F.col(text)).mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END_ID
) -> DataFrame:
    """Tokenize and pack all documents: key, piece, start, length, sequence_id, offset, ids.

    One row per piece; only documents of more than ``window`` tokens have several, all of
    them full windows but the last. A null or empty text is the end id alone. Rows of equal
    keys, or without one, are packed one by one. An empty table gives no pieces. Other
    columns are not read. Tokens are written once; only keys and lengths are sorted.
    """
    plain = docs.select(F.col(key).alias("__doc"), F.col(text).alias("text"))
    pieces = written(
        cut(plain, path, "text", window, end).withColumn("key", F.monotonically_increasing_id()), "pieces"
    )
    slots = written(assign(pieces.select("key", "piece", "length"), window), "slots")
    return pieces.join(slots.select("key", "sequence_id", "offset").hint("merge"), "key").select(
        F.col("__doc").alias(key), "piece", "start", "length", "sequence_id", "offset", "ids"
    )
