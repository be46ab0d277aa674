"""Compression of vectors to short codes by a codebook for each part of the components.

Components become integers, vectors are cut into equal parts, and every part is coded as
the number of the nearest entry of its codebook. Codebooks are fitted in rounds over all
vectors: a task adds up the parts that it assigned to each entry, so what is shuffled, and
what the driver sees, is one row per entry. Nearest entries are found by equal-average
search: entries are sorted by the sum of their components and tried outward from a part's
own sum, until the squared gap of the sums over the number of components, which no
squared distance falls short of, exceeds the best distance so far. All numbers are
integers, so results do not depend on the order of rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Of n rows, a label with n / HOT rows or more is one of HOT at most, and joined by broadcast.
HOT = 1000
# Parts that are searched together, and entries tried at a time on either side.
_BLOCK, _STEP = 512, 16


def _limit(width: int) -> int:
    """Integers below this in magnitude have squared distances that fit 64 bits."""
    limit = 1 << 30
    while 4 * width * limit * limit >= 1 << 63:
        limit >>= 1
    return limit


class Codebook:
    """Entries of one part position, ready for equal-average search."""

    def __init__(self, entries: np.ndarray):
        self.width = entries.shape[1]
        self.order = np.lexsort((np.arange(len(entries)), entries.sum(1)))
        self.entries = entries[self.order].astype(np.int64)
        self.sums = self.entries.sum(1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry to each part, ties to the lower."""
        number = np.zeros(len(parts), np.int64)
        distance = np.zeros(len(parts), np.int64)
        sums = parts.sum(1)
        order = np.argsort(sums, kind="stable")
        for at in range(0, len(parts), _BLOCK):
            rows = order[at : at + _BLOCK]
            number[rows], distance[rows] = self._block(parts[rows], sums[rows])
        return number, distance

    def _block(self, parts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = len(self.sums)
        # Parts with sums close to each other begin with the same entries.
        low, high = np.searchsorted(self.sums, [sums[0], sums[-1]])
        low, high = max(0, int(low) - _STEP), min(count, int(high) + _STEP)
        number = np.full(len(parts), count, np.int64)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        self._try(parts, np.arange(len(parts)), low, high, number, best)
        while low > 0:
            rows = np.flatnonzero(self._in_reach(sums, self.sums[low - 1], best))
            if not len(rows):
                break
            self._try(parts, rows, max(0, low - _STEP), low, number, best)
            low = max(0, low - _STEP)
        while high < count:
            rows = np.flatnonzero(self._in_reach(sums, self.sums[high], best))
            if not len(rows):
                break
            self._try(parts, rows, high, min(count, high + _STEP), number, best)
            high = min(count, high + _STEP)
        return number, best

    def _in_reach(self, sums, entry, best):
        """Whether the squared gap over the width does not exceed the best distance."""
        gap = np.abs(sums - entry)
        # The ceiling of the quotient exceeds an integer just when the quotient does.
        return -(-(gap * gap) // self.width) <= best

    def _try(self, parts, rows, low, high, number, best) -> None:
        entries = self.entries[low:high]
        some = parts[rows]
        if max(np.abs(some).max(initial=0), np.abs(entries).max(initial=0)) < 1 << 20 and self.width < 1 << 10:
            # Sums of products below 2**53: exact in double precision, and fast there.
            dots = (some.astype(np.float64) @ entries.T.astype(np.float64)).astype(np.int64)
            squares = (some * some).sum(1)[:, None] + (entries * entries).sum(1)
            distances = squares - 2 * dots
        else:
            distances = np.stack([((some - e) ** 2).sum(1) for e in entries], 1)
        least = distances.min(1)
        numbers = np.where(distances == least[:, None], self.order[low:high], len(self.sums)).min(1)
        better = (least < best[rows]) | ((least == best[rows]) & (numbers < number[rows]))
        rows = rows[better]
        number[rows], best[rows] = numbers[better], least[better]


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """The rows of a list column of one width."""
    width = len(column.flatten()) // max(1, len(column))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(dtype)


def integer_vectors(vectors: DataFrame, key: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """key, label, v: floor(scale * x) of every component, of the rows that are fit for it.

    Null vectors and those with null or non-finite components are left out.
    """
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fit = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    small = F.forall(F.col(vector), lambda x: F.abs(x.cast("double")) < float((1 << 31) // scale))
    checked = F.when(small, scaled.cast("array<int>")).otherwise(
        F.raise_error(F.lit(f"{vector}: components of {(1 << 31) // scale} or more have no integer code"))
    )
    return vectors.filter(F.col(vector).isNotNull()).filter(fit).select(
        F.col(key).alias("key"), F.col(label).alias("label"), checked.alias("v")
    )


def _widths(rows: DataFrame, parts: int) -> int | None:
    """The one width of all vectors, None if there are none."""
    found = rows.agg(
        F.min(F.size("v")), F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("long")))))
    ).first()
    if found[0] is None:
        return None
    if found[0] != found[1]:
        raise ValueError(f"vectors of {found[0]} and of {found[1]} components")
    if found[0] == 0 or found[0] % parts:
        raise ValueError(f"vectors of {found[0]} components cannot be cut into {parts} parts")
    if found[2] >= _limit(found[0]):
        raise ValueError(f"scaled components of {found[2]}: squared distances do not fit 64 bits")
    return found[0]


def first_entries(rows: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the least keys, ``entries`` of them; equal keys in the order of the
    vectors, rows without a key last. Keys are chosen before vectors are fetched."""
    ids = rows.select("key").orderBy(F.col("key").asc_nulls_last()).limit(entries).collect()
    last = ids[-1]["key"]
    chosen = rows if last is None else rows.filter(F.col("key") <= F.lit(last))
    # Repeated rows are counted before they are sorted, however many there are.
    found = (
        chosen.groupBy("key", "v").count().orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).collect()
    )
    out = [row["v"] for row in found for _ in range(min(entries, row["count"]))]
    return np.array(out[:entries], np.int64)


def _round(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks moved to the floor of the means of the parts that are nearest to them."""
    width = books[0].shape[1]
    names = [f"s{i}" for i in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{name} long" for name in names)

    def assign(batches):
        tools = [Codebook(book) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros(book.shape, np.int64) for book in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _matrix(batch.column(0), np.int64)
            for part, tool in enumerate(tools):
                own = whole[:, part * width : (part + 1) * width]
                number, _ = tool.nearest(own)
                counts[part] += np.bincount(number, minlength=len(counts[part]))
                order = np.argsort(number, kind="stable")
                heads = np.flatnonzero(np.diff(number[order], prepend=-1))
                sums[part][number[order][heads]] += np.add.reduceat(own[order], heads)
        for part in range(len(books)):
            used = np.flatnonzero(counts[part])
            columns = [np.full(len(used), part, np.int32), used.astype(np.int32), counts[part][used]]
            columns += list(sums[part][used].T)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["part", "entry", "n", *names])

    totals = rows.select("v").mapInArrow(assign, schema).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(name).alias(name) for name in names)
    )
    out = [book.copy() for book in books]
    for row in totals.collect():  # one row per entry at most
        out[row["part"]][row["entry"]] = [row[name] // row["n"] for name in names]
    return out


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """A codebook for each part of ``rows`` of ``integer_vectors``; none if there are none."""
    width = _widths(rows, parts)
    if width is None:
        return []
    books = [b.copy() for b in np.split(first_entries(rows, entries), parts, axis=1)]
    for _ in range(rounds):
        books = _round(rows, books)
    return books


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """key, label, code (binary: the entry's number of each part in as few bytes as numbers
    need), error (squared distance to what the code stands for)."""
    kind = np.dtype(np.uint8 if max((len(b) for b in books), default=0) <= 256 else ">u4")
    fields = {f.name: f for f in rows.schema.fields}
    schema = T.StructType(
        [fields["key"], fields["label"], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    )

    def run(batches):
        tools = [Codebook(book) for book in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = np.split(_matrix(batch.column(2), np.int64), len(tools), axis=1)
            found = [tool.nearest(part) for tool, part in zip(tools, whole)]
            codes = np.stack([number for number, _ in found], 1).astype(kind)
            error = reduce(add, [distance for _, distance in found])
            size = codes.shape[1] * kind.itemsize
            code = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(size), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes).tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), code.cast(pa.binary()), pa.array(error)], schema.names
            )

    return rows.select("key", "label", "v").mapInArrow(run, schema)


def decode(codes: DataFrame, books: list[np.ndarray], code: str = "code", scale: int = SCALE) -> DataFrame:
    """``codes`` with the column ``vector``: the entries that a code stands for, in the
    input's scale. A null code has a null vector. Needs books of at most 256 entries."""
    tables = [F.lit([[float(x) / scale for x in e] for e in book.tolist()]) for book in books]
    pieces = [
        F.element_at(t, F.conv(F.hex(F.substring(code, i + 1, 1)), 16, 10).cast("int") + 1) for i, t in enumerate(tables)
    ]
    return codes.withColumn("vector", F.flatten(F.array(*pieces)))


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` (written; key, label, code, error) with the sum of ``error`` over its label.

    Null is a label of its own. Sums are combined before they are shuffled. Labels that
    hold a thousandth of all rows or more, a thousand at most, are joined by broadcast, so
    no key of the shuffled join holds more than that.
    """
    sums = materialize(
        coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors"
    )
    labels, total = sums.agg(F.count(F.lit(1)), F.sum("n")).first()
    named = sums.withColumnRenamed("label", "__label")
    same = F.col("label").eqNullSafe(F.col("__label"))
    if labels <= HOT:
        return coded.join(F.broadcast(named.drop("n")), same, "left").drop("__label")
    hot = named.filter(F.col("n") * HOT >= total).drop("n")
    rest = named.filter(F.col("n") * HOT < total).drop("n").withColumnRenamed("label_error", "__cold")
    first = coded.join(F.broadcast(hot), same, "left").drop("__label")
    return (
        first.filter("label_error is not null")
        .unionByName(
            first.filter("label_error is null")
            .drop("label_error")
            .join(rest.hint("merge"), same)
            .withColumnRenamed("__cold", "label_error")
            .drop("__label")
        )
    )


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """key, label, code, error, label_error of every vector that is fit, and the codebooks.

    Null vectors and those with null or non-finite components have no row. An empty table,
    or one without fit vectors, gives no rows and no codebooks. Rows of equal keys, or
    without one, are coded one by one; which of them the codebooks start from is said in
    ``first_entries``. Vectors of unlike widths, of a width that ``parts`` does not divide,
    or with components too large for 64-bit distances are an error. Other columns are not
    read. Integer vectors are written once and read in every round.
    """
    rows = materialize(integer_vectors(vectors, key, vector, label, scale), "integer-vectors")
    books = fit(rows, parts, entries, rounds)
    if not books:
        empty = rows.select(
            "key", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")
        ).limit(0)
        return empty.withColumnRenamed("key", key), []
    coded = materialize(encode(rows, books), "codes")
    return with_label_error(coded).withColumnRenamed("key", key), books
