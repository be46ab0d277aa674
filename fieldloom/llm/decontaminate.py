"""Benchmark decontamination with suffix arrays over the training documents.

Every shard of documents becomes an array of word codes with its suffix array, sorted
as deep as a window is long. Every suffix of every benchmark item is binary-searched in
it; the range found gives all places of the window, and reading on from there the
longest verbatim match. Documents lie whole in one shard, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_bytes, word_codes

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20
# Benchmark text that is sent to every executor at once. A larger benchmark is worked
# off in several rounds of at most so many bytes (or one item) each.
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 4 << 20

_REPORT = {
    "n_words": T.LongType(),
    "n_hit": T.LongType(),
    "n_items": T.LongType(),
    "items_sha256": T.StringType(),
    "contaminated": T.BooleanType(),
    "longest_words": T.LongType(),
    "longest_start": T.LongType(),
    "longest_item": T.StringType(),
}
_STATE = T.StructType(
    [
        T.StructField("hits", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("best", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("item", T.StringType()),
    ]
)


def _byte_table() -> np.ndarray:
    """Byte to lower-cased word byte; 0 where no word goes on."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if 0x41 <= b <= 0x5A else b
        if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80:
            out[b] = c
    return out


_BYTES = _byte_table()


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Start positions of all suffixes in the order of their first ``depth`` words.

    Prefix doubling: positions are ranked by one word, two, four, ...; in each round
    only those that still share their rank are sorted again. Ties beyond ``depth``
    keep an arbitrary order.
    """
    count = len(words)
    order = np.argsort(words, kind="stable")
    rank = np.empty(count, np.int64)
    sorted_ = words[order]
    new = np.ones(count, bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    heads = np.flatnonzero(new)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, count)))
    have = 1
    while have < depth and len(heads) < count:
        # Slots of the order whose suffixes are not yet alone with their rank.
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        where = order[slots]
        ahead = where + have
        next_rank = np.where(ahead < count, rank[np.minimum(ahead, count - 1)] + 1, 0)
        group = rank[where]
        key = group * (count + 1) + next_rank
        inner = np.argsort(key, kind="stable")
        key, where = key[inner], where[inner]
        order[slots] = where
        differs = np.ones(len(slots), bool)
        differs[1:] = key[1:] != key[:-1]
        new[slots] |= differs
        heads = np.flatnonzero(new)
        ranks = np.repeat(heads, np.diff(np.append(heads, count)))
        rank[where] = ranks[slots]
        have *= 2
    return order


def _compare(text, suffixes, query, starts, lengths):
    """-1, 0 or 1 for each suffix of ``text`` against its query, over the query's length."""
    out = np.zeros(len(suffixes), np.int8)
    open_ = np.arange(len(suffixes))
    for k in range(int(lengths.max(initial=0))):
        open_ = open_[lengths[open_] > k]
        if not len(open_):
            break
        place = suffixes[open_] + k
        left = np.where(place < len(text), text[np.minimum(place, len(text) - 1)], np.uint64(0))
        right = query[starts[open_] + k]
        out[open_[left < right]] = -1
        out[open_[left > right]] = 1
        open_ = open_[left == right]
    return out


def search(text, order, query, starts, lengths) -> tuple[np.ndarray, np.ndarray]:
    """Range of ``order`` whose suffixes start with each query, found by binary search."""

    def bound(upper: bool) -> np.ndarray:
        lo = np.zeros(len(starts), np.int64)
        hi = np.full(len(starts), len(order), np.int64)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            side = _compare(text, order[mid], query, starts[open_], lengths[open_])
            right = side <= 0 if upper else side < 0
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
            open_ = np.flatnonzero(lo < hi)
        return lo

    return bound(False), bound(True)


@dataclass
class TestSet:
    """Word codes of benchmark items, a 0 behind each, and their distinct windows.

    Equal windows are one; ``borders`` has where the places of each begin in ``places``,
    which come in the order of the whole suffixes that begin there.
    """

    __test__ = False

    ids: list[str]
    words: np.ndarray
    left: np.ndarray  # words from each place up to the end of its item, the 0 included
    starts: np.ndarray
    lengths: np.ndarray
    borders: np.ndarray
    places: np.ndarray
    item: np.ndarray  # of each of ``places``

    def items(self, windows: np.ndarray) -> list[str]:
        """Ids of all items that hold one of the windows, each once and in order."""
        parts = [self.item[self.borders[w] : self.borders[w + 1]] for w in windows]
        return sorted({self.ids[i] for i in np.unique(np.concatenate(parts))})


def _separated(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of rows with a 0 behind each row, which no match goes across, and where rows begin."""
    shift = np.arange(len(counts) - 1)
    out = np.zeros(len(codes) + len(shift), np.uint64)
    out[np.arange(len(codes)) + np.repeat(shift, np.diff(counts))] = codes
    return out, counts[:-1] + shift


def read_tests(ids: list[str], texts: list[str | None], window: int = WINDOW) -> TestSet:
    raw, offsets = text_bytes(pa.array(texts, pa.large_string()))
    codes, counts = word_codes(raw, offsets, _BYTES)
    words, begin = _separated(codes, counts)
    sizes = np.diff(counts)
    item = np.repeat(np.arange(len(sizes)), sizes + 1)
    left = (begin + sizes + 1)[item] - np.arange(len(words))
    length = np.minimum(window, sizes)[item]
    is_start = (left > length) & (length > 0)
    order = suffix_array(words, int(sizes.max(initial=0)) + 1) if len(words) else np.zeros(0, np.int64)
    places = order[is_start[order]]
    same = length[places[1:]] == length[places[:-1]]
    for k in range(window):
        here, before = (np.minimum(x + k, len(words) - 1) for x in (places[1:], places[:-1]))
        same &= (words[here] == words[before]) | (k >= length[places[1:]])
    heads = np.flatnonzero(np.append(True, ~same)) if len(places) else np.zeros(0, np.int64)
    starts = places[heads]
    return TestSet(
        list(ids), words, left, starts, length[starts], np.append(heads, len(places)), places, item[places]
    )


def _matches(text, order, tests: TestSet):
    """All pairs (place in ``text``, window) with equal words.

    As equal windows are one, a place has at most one of each length.
    """
    present = np.isin(tests.words[tests.starts], text) if len(text) else np.zeros(0, bool)
    chosen = np.flatnonzero(present)
    if not len(chosen):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo, hi = search(text, order, tests.words, tests.starts[chosen], tests.lengths[chosen])
    sizes = hi - lo
    window = np.repeat(chosen, sizes)
    inner = np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return order[np.repeat(lo, sizes) + inner], window


def _nearest(text, places, tests: TestSet, windows) -> np.ndarray:
    """For each place the number, in ``tests.places``, of the first suffix of its window
    that is not less than the text from there on, or of the window's last one."""
    lo, hi = tests.borders[windows], tests.borders[windows + 1] - 1
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) // 2
        there = tests.places[mid]
        above = _compare(text, places[open_], tests.words, there, tests.left[there]) > 0
        lo[open_[above]] = mid[above] + 1
        hi[open_[~above]] = mid[~above]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


def _extend(text, places, tests: TestSet, windows) -> tuple[np.ndarray, np.ndarray]:
    """Words that agree from each place on with an item, and the item.

    The longest match is with a neighbour of the text in the order of suffixes. What also
    agrees one word further left is part of a longer match and is not read on.
    """
    last = _nearest(text, places, tests, windows)
    length, number = tests.lengths[windows].copy(), last.copy()
    for candidate in (last, np.maximum(last - 1, tests.borders[windows])):
        there = tests.places[candidate]
        own = tests.lengths[windows].copy()
        inner = (places > 0) & (there > 0) & (text[places - 1] == tests.words[there - 1])
        open_ = np.flatnonzero(~(inner & (text[places - 1] != 0)))
        while len(open_):
            a, b = places[open_] + own[open_], there[open_] + own[open_]
            go = (a < len(text)) & (tests.words[b] != 0)
            open_, a, b = open_[go], a[go], b[go]
            open_ = open_[text[a] == tests.words[b]]
            own[open_] += 1
        better = own > length
        length[better], number[better] = own[better], candidate[better]
    return length, tests.item[number]


def _shard(batch: pa.RecordBatch, column: str, tests: TestSet, window: int):
    """Per row: number of words, hit positions, items and the longest match."""
    raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    codes, counts = word_codes(raw, offsets, _BYTES)
    text, begin = _separated(codes, counts)
    order = suffix_array(text, window) if len(codes) else np.zeros(0, np.int64)
    places, windows = _matches(text, order, tests)
    longest, with_item = _extend(text, places, tests, windows)
    marks = np.zeros(len(text) + 1, np.int64)
    marks += np.bincount(places, minlength=len(marks))
    marks -= np.bincount(places + tests.lengths[windows], minlength=len(marks))
    hit = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
    hit_row = np.searchsorted(begin, hit, "right") - 1
    row = np.searchsorted(begin, places, "right") - 1
    distinct = max(1, len(tests.starts))
    window_row, window = np.divmod(np.unique(row * distinct + windows), distinct)
    bounds = lambda values, r: slice(*np.searchsorted(values, [r, r + 1]))
    by_row = np.lexsort((places, -longest, row))
    sorted_row = row[by_row]
    # Rows with the same windows share the list of their items.
    lists: dict[bytes, list[str]] = {}
    found = {}
    for r in np.unique(row).tolist():
        best = by_row[np.searchsorted(sorted_row, r)]
        own = window[bounds(window_row, r)]
        known = own.tobytes()
        if known not in lists:
            lists[known] = tests.items(own)
        found[r] = (
            (hit[bounds(hit_row, r)] - begin[r]).tolist(),
            lists[known],
            int(longest[best]),
            int(places[best] - begin[r]),
            tests.ids[with_item[best]],
        )
    return np.diff(counts), found


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    window: int = WINDOW,
    share: int = SHARE,
) -> DataFrame:
    """All columns of ``docs`` plus what the benchmark's windows hit in each text.

    n_words, n_hit (words inside any occurrence), n_items, items_sha256, contaminated
    (n_hit > 0 and share * n_hit >= n_words), and the longest verbatim match:
    longest_words, longest_start (its first word), longest_item. A null or empty text
    has no words, no hits and the digest of nothing; the longest match of a document
    without hits is 0 words at null. Items without words have no windows, null ids of
    items are written as ''. Repeated rows are judged one by one. Columns of ``docs``
    named like a report column are replaced.
    """
    base = docs.select(*[c for c in docs.columns if c not in _REPORT])
    state = T.StructType([*base.schema.fields, T.StructField("__state", _STATE)])
    result = T.StructType(
        [*base.schema.fields, *(T.StructField(k, v) for k, v in _REPORT.items())]
    )
    frame = base
    # One block at a time is on the driver; what has been sent lies in files.
    rounds = _blocks(benchmark, item)
    block, i = next(rounds), 0
    while block is not None:
        tests = docs.sparkSession.sparkContext.broadcast(read_tests(*block, window))
        block = next(rounds, None)
        task = _Round(tests, text, window, share, i > 0, block is None)
        frame, i = frame.mapInArrow(task, result if block is None else state), i + 1
    return frame


def _blocks(benchmark: DataFrame, item: str) -> Iterator[tuple[list, list]]:
    """The items in blocks of at most ``BLOCK_BYTES``; at least one block, maybe empty."""
    ids, texts, size, any_ = [], [], 0, False
    rows = benchmark.select(F.col(item).cast("string").alias("item"), "text")
    for row in rows.toLocalIterator():
        length = len((row["text"] or "").encode())
        if ids and size + length > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size, any_ = [], [], 0, True
        ids.append(row["item"] or "")
        texts.append(row["text"])
        size += length
    if ids or not any_:
        yield ids, texts


@dataclass
class _Round:
    """One block of the benchmark against the documents of a task."""

    tests: object
    text: str
    window: int
    share: int
    resumed: bool
    last: bool

    def __call__(self, batches):
        for batch in slices(batches, self.text, SHARD_BYTES):
            sizes, found = _shard(batch, self.text, self.tests.value, self.window)
            columns, names = list(batch.columns), list(batch.schema.names)
            if self.resumed:
                for r, old in enumerate(columns.pop().to_pylist()):
                    if old["items"]:
                        found[r] = _merged(old, found.get(r, ([], [], 0, -1, None)))
                names.pop()
            nothing = ([], [], 0, None, None)
            rows = [found.get(r, nothing) for r in range(batch.num_rows)]
            if self.last:
                hits = np.array([len(x[0]) for x in rows], np.int64)
                items = [x[1] for x in rows]
                columns += [
                    pa.array(sizes.astype(np.int64)),
                    pa.array(hits),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([_digest(x) for x in items], pa.string()),
                    pa.array((hits > 0) & (self.share * hits >= sizes)),
                    pa.array([x[2] for x in rows], pa.int64()),
                    pa.array([x[3] for x in rows], pa.int64()),
                    pa.array([x[4] for x in rows], pa.string()),
                ]
                names += list(_REPORT)
            else:
                keys = ("hits", "items", "best", "at", "item")
                kind = pa.struct(
                    [
                        ("hits", pa.list_(pa.int64())),
                        ("items", pa.list_(pa.string())),
                        ("best", pa.int64()),
                        ("at", pa.int64()),
                        ("item", pa.string()),
                    ]
                )
                columns.append(pa.array([dict(zip(keys, x)) for x in rows], kind))
                names.append("__state")
            yield pa.RecordBatch.from_arrays(columns, names)


def _merged(old: dict, new: tuple) -> tuple:
    better = old["best"] >= new[2]
    return (
        sorted({*old["hits"], *new[0]}),
        sorted({*old["items"], *new[1]}),
        old["best"] if better else new[2],
        old["at"] if better else new[3],
        old["item"] if better else new[4],
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``docs``."""
    if not set(docs.columns) & set(_REPORT):
        marked = contamination(docs, benchmark, **options)
        return marked.filter(~F.col("contaminated")).select(*docs.columns)
    # A report column would replace one of the documents': keep the rows in a struct.
    text = options.get("text", "text")
    packed = docs.select(F.col(text), F.struct(*docs.columns).alias("__row"))
    marked = contamination(packed, benchmark, **options)
    return marked.filter(~F.col("contaminated")).select("__row.*")
