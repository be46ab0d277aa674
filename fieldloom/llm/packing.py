"""Packing of token sequences into windows of one length.

Documents are cut into full windows and a rest. The rests' lengths are counted by class;
shallow combinations of classes that fill a window are the columns, and their repeat
counts the unknowns, of a non-negative least squares problem against that histogram.
The rounded counts give every rest a window by its rank in its class alone. What runs
over a window's end, and the rests that no window was left for, are then packed
greedily, one behind the other, and cut at the windows' ends. So no window but the very
last one has padding.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import with_running_total, written
from .huffman import _flat
from .tokens import END_ID, binaries, id_type, tokenized

WINDOW = 4096
#: Rests are counted in classes of so many lengths.
STEP = 64
#: Most rests in one window.
DEPTH = 6


def combinations(units: int, depth: int) -> np.ndarray:
    """All multisets of at most ``depth`` numbers from 1 on with the sum ``units``:
    a row each, with the count of every number from 0 to ``units``."""
    rows = []

    def extend(chosen, least, left):
        if left == 0:
            rows.append(list(chosen))
            return
        places = depth - len(chosen)
        if places == 0:
            return
        for number in range(least, left // places + 1 if places == 1 else left + 1):
            if number != left and (places == 1 or left - number < number):
                continue
            extend([*chosen, number], number, left - number)

    extend([], 1, units)
    # The loop above meets a sum in non-decreasing numbers only, each once.
    out = np.zeros((len(rows), units + 1), np.int16)
    for i, row in enumerate(rows):
        np.add.at(out[i], row, 1)
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-10) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x = np.zeros(n)
    free = np.zeros(n, bool)
    gradient = a.T @ b
    for _ in range(3 * a.shape[0] + 10):
        candidates = np.where(free, -np.inf, gradient)
        best = int(np.argmax(candidates)) if n else 0
        if not n or candidates[best] <= tolerance:
            break
        free[best] = True
        while True:
            index = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, index], b, rcond=None)[0]
            if z.min(initial=1.0) > 0:
                x[:] = 0
                x[index] = z
                break
            bad = z <= 0
            old = x[index]
            ratio = old[bad] / np.maximum(old[bad] - z[bad], 1e-300)
            x[index] = old + ratio.min(initial=1.0) * (z - old)
            drop = index[(x[index] <= tolerance * 1e-3) & bad]
            if not len(drop):
                drop = index[bad][np.argmin(ratio)][None]
            x[drop] = 0
            free[drop] = False
        gradient = a.T @ (b - a @ x)
    return x


def repeat_counts(histogram: np.ndarray, units: int, depth: int = DEPTH):
    """Combinations and how often each is used, never more than the histogram has.

    ``histogram[c]`` is the number of rests in class c. The least squares solution is
    rounded down to what is left of every class, the largest counts first.
    """
    columns = combinations(units, depth)
    total = max(1, int(histogram.sum()))
    solved = nnls(columns[:, : len(histogram)].T.astype(float), histogram / total) * total
    used = np.flatnonzero(solved >= 1)
    used = used[np.argsort(-solved[used], kind="stable")]
    left = histogram.astype(np.int64).copy()
    chosen, counts = [], []
    for i in used:
        need = columns[i][: len(left)]
        where = np.flatnonzero(need)
        if columns[i][len(left) :].any():
            continue
        count = min(int(solved[i] + 1e-6), int((left[where] // need[where]).min()))
        if count > 0:
            left[where] -= count * need[where].astype(np.int64)
            chosen.append(columns[i])
            counts.append(count)
    return chosen, counts


class Assignment:
    """Window and place of a rest from its class and its rank in the class."""

    def __init__(self, chosen, counts, first: int):
        spans: dict[int, list] = {}
        taken: dict[int, int] = {}
        window = first
        for need, count in zip(chosen, counts):
            # The longest rests come last, so that the cut falls into one of them.
            place = 0
            for cls in np.flatnonzero(need):
                for _ in range(int(need[cls])):
                    begin = taken.get(int(cls), 0)
                    spans.setdefault(int(cls), []).append((begin, begin + count, window, place))
                    taken[int(cls)] = begin + count
                    place += 1
            window += count
        self.windows = window
        self.spans = {c: np.array(s, np.int64) for c, s in spans.items()}

    def __call__(self, classes: np.ndarray, ranks: np.ndarray):
        window = np.full(len(classes), -1, np.int64)
        place = np.zeros(len(classes), np.int64)
        for cls in np.unique(classes):
            spans = self.spans.get(int(cls))
            if spans is None:
                continue
            rows = np.flatnonzero(classes == cls)
            rank = ranks[rows]
            at = np.searchsorted(spans[:, 1], rank, "right")
            inside = at < len(spans)
            rows, rank, at = rows[inside], rank[inside], at[inside]
            window[rows] = spans[at, 2] + rank - spans[at, 0]
            place[rows] = spans[at, 3]
        return window, place


def plan(lengths: DataFrame, key: str, window: int = WINDOW, step: int = STEP, depth: int = DEPTH):
    """Pieces of sequences of ``lengths`` (a unique ``key``, n_tokens): key, start, length,
    sequence_id, offset. Sequences without tokens have no piece.

    Only the class histogram (window / step numbers) and sums of the parts of an order
    reach the driver; the table of repeat counts is as bounded.
    """
    spark = lengths.sparkSession
    base = lengths.select(
        F.col(key).alias("__key"),
        F.floor(F.col("n_tokens") / window).cast("long").alias("full"),
        (F.col("n_tokens") % window).cast("long").alias("rest"),
    )
    long_, windows = with_running_total(
        base.filter("full > 0").select("__key", "full"), ["__key"], "full", "first", "full-windows"
    )
    full = long_.select("__key", "first", F.posexplode(F.sequence(F.lit(1), F.col("full")))).select(
        "__key",
        (F.col("pos") * window).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        (F.col("first") + F.col("pos")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rests = base.filter("rest > 0").select(
        "__key",
        (F.col("full") * window).alias("start"),
        "rest",
        F.floor(F.col("rest") / step).cast("int").alias("cls"),
        F.lit(1).cast("long").alias("one"),
    )
    ranked, _ = with_running_total(rests, ["cls", "__key"], "one", "number", "rests")
    histogram = np.zeros(-(-window // step), np.int64)
    for row in ranked.groupBy("cls").count().collect():
        histogram[row["cls"]] = row["count"]
    usable = histogram.copy()
    usable[0] = 0  # shorter than a step: nothing to count on
    chosen, counts = repeat_counts(usable, window // step, depth)
    assignment = Assignment(chosen, counts, windows)
    before = np.cumsum(histogram) - histogram
    assigned = spark.sparkContext.broadcast((assignment, before))

    @F.pandas_udf("window long, place long")
    def assign(cls: pd.Series, number: pd.Series) -> pd.DataFrame:
        given, starts = assigned.value
        classes = cls.to_numpy()
        found, place = given(classes, number.to_numpy() - starts[classes])
        return pd.DataFrame({"window": found, "place": place})

    placed = written(
        ranked.withColumn("__at", assign("cls", "number")).select(
            "__key", "start", "rest", "__at.window", "__at.place"
        ),
        "placed",
    )
    # At most ``depth`` rows share a window.
    along = W.partitionBy("window").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    members = (
        placed.filter("window >= 0")
        .withColumn("offset", F.coalesce(F.sum("rest").over(along), F.lit(0)))
        .withColumn(
            "length", F.greatest(F.lit(0), F.least(F.col("rest"), F.lit(window) - F.col("offset")))
        )
    )
    fitted = members.filter("length > 0").select(
        "__key", "start", "length", F.col("window").alias("sequence_id"), "offset"
    )
    over = members.filter("length < rest").select(
        "__key", (F.col("start") + F.col("length")).alias("start"),
        (F.col("rest") - F.col("length")).alias("rest"),
    )
    loose = placed.filter("window < 0").select("__key", "start", "rest").unionByName(over)
    stream, _ = with_running_total(loose, ["__key", "start"], "rest", "at", "loose")
    room = F.lit(window) - F.col("at") % window
    first = F.least(F.col("rest"), room)
    piece = lambda start, length, at: F.struct(
        start.alias("start"),
        length.alias("length"),
        (F.floor(at / window) + assignment.windows).cast("long").alias("sequence_id"),
        (at % window).alias("offset"),
    )
    # A rest is shorter than a window, so it is cut once at most.
    greedy = stream.select(
        "__key",
        F.explode(
            F.array(
                piece(F.col("start"), first, F.col("at")),
                piece(F.col("start") + first, F.col("rest") - first, F.col("at") + first),
            )
        ).alias("p"),
    ).filter("p.length > 0")
    return full.unionByName(fitted).unionByName(greedy.select("__key", "p.*")).withColumnRenamed(
        "__key", key
    )


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
    end: int = END_ID,
) -> DataFrame:
    """Tokenize and pack all documents: key, start, length, doc_tokens, sequence_id, offset, ids.

    One row per piece; ``ids`` are its tokens, four little-endian bytes each. A null or
    empty text is the end id alone. Rows of equal keys are packed one by one. Only the
    last sequence can be short of ``window``. An empty table gives no pieces.
    """
    kind = id_type(path, end)
    plain = docs.select(F.col(key).alias("__doc"), F.col(text).alias("text"))
    numbered = tokenized(plain, path, end=end).withColumn("__row", F.monotonically_increasing_id())
    tokens = written(numbered, "tokens")
    # Planned once: the order of parts with equal keys must not change between uses.
    pieces = written(plan(tokens.select("__row", "n_tokens"), "__row", window), "pieces")
    width = np.dtype(kind).itemsize
    cut = (
        tokens.join(pieces.hint("merge"), "__row")
        .select(
            F.col("__doc").alias(key),
            "start",
            "length",
            F.col("n_tokens").alias("doc_tokens"),
            "sequence_id",
            "offset",
            F.expr(f"substring(ids, cast(start * {width} + 1 as int), cast(length * {width} as int))").alias("ids"),
        )
    )
    if kind == np.uint32:
        return cut

    def widen(batches):
        for batch in batches:
            ids, offsets = _flat(batch.column(batch.schema.get_field_index("ids")), kind)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], binaries(ids.astype("<u4"), offsets)], batch.schema.names
            )

    return cut.mapInArrow(widen, cut.schema)
