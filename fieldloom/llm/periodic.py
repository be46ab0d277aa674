"""Detection of runs: stretches of words that repeat with a period several times over.

A run of period q and an exponent of e has each of its words floor(e) times, and all words
but those next to its ends in a repeated word sequence. So words that are too rare in their
stretch of a document to be in any run end that stretch, as a unique letter would; what is
left, most of a text is not, goes through suffix trees. Ukkonen trees of the stretches and
of their reversal, walked in order, give longest common extensions in constant time as
range minima of the tour. Every run has a Lyndon root that is the longest Lyndon word at
its place in one of two opposite orders of the letters, so the two Lyndon tables have all
candidates; each is extended in both directions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, slices, text_bytes

LEAST_WORDS, EXPONENT = 6, 4
# Stretches share a tree up to about this many words; a longer one has its own.
_TREE = 50_000
# Lengths of the word sequences that have to repeat; see ``candidates``.
_GRAMS = (1, 4, 2)
_ROUNDS = 6

# Bytes count as themselves, white space as what lies between words. A NUL byte is part of
# a word; 0xFF, which UTF-8 has nowhere, stands for it.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[[0x20, *range(0x09, 0x0E)]] = 0
_BYTES[0] = 0xFF


class SuffixTree:
    """The suffix tree of ``s``, numbers from 0 to ``symbols`` - 1 with a last one of its own.

    Built by Ukkonen's algorithm. ``rank`` is the place of each suffix in order, or, for
    the order ``other`` of the symbols, what ``ranks`` returns.
    """

    def __init__(self, s: np.ndarray, symbols: int):
        self.n = len(s)
        self.symbols = symbols
        child, start, end = self._build(s.tolist(), symbols)
        nodes = len(start)
        keys = np.fromiter(child.keys(), np.int64, nodes - 1)
        self.nodes = np.fromiter(child.values(), np.int64, nodes - 1)
        self.parents, self.edges = np.divmod(keys, symbols)
        self.parent = np.zeros(nodes, np.int64)
        self.parent[self.nodes] = self.parents
        end = np.array(end, np.int64)
        self.leaf = end < 0
        end[self.leaf] = self.n
        self.depth = self._depths(end - np.array(start, np.int64))
        tour = self._tour(self.edges)
        leaves = np.flatnonzero(self.leaf[tour])
        self.rank = self._rank(tour[leaves])
        # Between two leaves the tour turns back down at the parent of the node it visits
        # next after the first of them: their lowest common ancestor.
        turns = self.depth[self.parent[tour[leaves[:-1] + 1]]]
        self.minima = [turns]
        width = 1
        while 2 * width <= len(turns):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    @staticmethod
    def _build(s: list[int], symbols: int):
        child: dict[int, int] = {}
        start, end, link = [0], [0], [0]
        node = edge = length = waiting = 0
        find = child.get
        for i, c in enumerate(s):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                key = node * symbols + s[edge]
                down = find(key)
                if down is None:
                    child[key] = len(start)
                    start.append(i), end.append(-1), link.append(0)
                    if unlinked:
                        link[unlinked] = node
                    unlinked = node
                else:
                    begin = start[down]
                    size = (end[down] if end[down] >= 0 else i + 1) - begin
                    if length >= size:
                        edge += size
                        length -= size
                        node = down
                        continue
                    if s[begin + length] == c:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    inner = len(start)
                    child[key] = inner
                    start.append(begin), end.append(begin + length), link.append(0)
                    child[inner * symbols + c] = inner + 1
                    start.append(i), end.append(-1), link.append(0)
                    start[down] = begin + length
                    child[inner * symbols + s[begin + length]] = down
                    if unlinked:
                        link[unlinked] = inner
                    unlinked = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        return child, start, end

    def _depths(self, size: np.ndarray) -> np.ndarray:
        """Sums of edge lengths up to the root, by doubling the way that is summed."""
        depth, up = size.copy(), self.parent.copy()
        while up.any():
            depth += depth[up]
            up = up[up]
        return depth

    def _tour(self, symbols: np.ndarray) -> np.ndarray:
        """All nodes in the order of a walk that takes edges by ``symbols``."""
        order = np.lexsort((-symbols, self.parents))
        below = self.nodes[order].tolist()
        bounds = np.searchsorted(self.parents[order], np.arange(len(self.parent) + 1)).tolist()
        leaf = self.leaf.tolist()
        stack, tour = [0], []
        while stack:
            node = stack.pop()
            tour.append(node)
            if not leaf[node]:
                stack += below[bounds[node] : bounds[node + 1]]
        return np.array(tour, np.int64)

    def _rank(self, leaves: np.ndarray) -> np.ndarray:
        rank = np.empty(self.n, np.int64)
        rank[self.n - self.depth[leaves]] = np.arange(self.n)
        return rank

    def ranks(self, other: np.ndarray) -> np.ndarray:
        """Places of the suffixes if symbol c counts as ``other[c]``."""
        tour = self._tour(other[self.edges])
        return self._rank(tour[self.leaf[tour]])

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How long the suffixes at ``a`` and at ``b``, other ones, agree."""
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            rows = np.flatnonzero(level == k)
            minima = self.minima[k]
            out[rows] = np.minimum(minima[low[rows]], minima[high[rows] - (1 << int(k))])
        return out


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place: as far as the next smaller suffix."""
    out = np.empty(len(rank), np.int64)
    ranks, stack = rank.tolist(), []
    for i, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            j = stack.pop()
            out[j] = i - j
        stack.append(i)
    for j in stack:
        out[j] = len(ranks) - j
    return out


def runs_of(stretches: list[np.ndarray], least: int, exponent: int) -> np.ndarray:
    """Rows (stretch, start, length, period) of all runs of the stretches (arrays of numbers)."""
    count = len(stretches)
    sizes = np.array([len(x) for x in stretches], np.int64)
    if not sizes.sum():
        return np.zeros((0, 4), np.int64)
    _, letters = np.unique(np.concatenate(stretches), return_inverse=True)
    letters = letters + count + 1
    # Marks of their own, less than all letters in either order, before, between and behind.
    s = np.empty(len(letters) + count + 1, np.int64)
    first = np.cumsum(sizes) - sizes + np.arange(count) + 1
    marks = np.append(first - 1, len(s) - 1)
    inner = np.ones(len(s), bool)
    inner[marks] = False
    s[marks] = np.arange(count + 1)
    s[inner] = letters
    symbols = int(letters.max()) + 1
    forward = SuffixTree(s, symbols)
    opposite = np.concatenate([np.arange(count + 1), np.arange(symbols, count + 1, -1)])
    places = np.flatnonzero(inner)
    found = []
    for rank in (forward.rank, forward.ranks(opposite)):
        found.append(np.stack([places, lyndon_lengths(rank)[places]], 1))
    found = np.unique(np.concatenate(found), axis=0)
    at, period = found[:, 0], found[:, 1]
    right = forward.extension(at, at + period)
    # The first root of a run begins within its first period, so it goes on for at least
    # exponent - 2 periods behind the root.
    good = right >= (exponent - 2) * period
    at, period, right = at[good], period[good], right[good]
    del forward
    if not len(at):
        return np.zeros((0, 4), np.int64)
    backward = SuffixTree(s[::-1].copy(), symbols)
    end = len(s)
    left = backward.extension(end - at, end - at - period)
    start, length = at - left, period + left + right
    good = (length >= exponent * period) & (length >= least)
    rows = np.unique(np.stack([start[good], length[good], period[good]], 1), axis=0)
    stretch = np.searchsorted(first, rows[:, 0], "right") - 1
    rows[:, 0] -= first[stretch]
    return np.column_stack([stretch, rows])


def _grams(codes: np.ndarray, parts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all sequences of ``size`` words inside one part, their numbers, and counts."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.flatnonzero(parts[:count] == parts[size - 1 :])
    numbers = parts[place].astype(np.int64)
    for j in range(size):
        _, numbers = np.unique(numbers * (int(codes.max()) + 1) + codes[place + j], return_inverse=True)
    return place, numbers, np.bincount(numbers)


def candidates(codes: np.ndarray, docs: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may be in runs, and the number of the stretch of each.

    A run of period q has at least max(least, exponent * q) words, so a sequence of m
    words that starts in it starts there floor((max(..) - m + 1) / q) times or more: with
    6 words and an exponent of 4 that is 4 times for m = 1, 3 for m = 2 and twice for m = 4,
    and such sequences cover the run. Words of a stretch that no such sequence covers are
    in no run and cut it. All runs of a document are found whole in the stretches that are
    left, however often this is done.
    """
    place = np.arange(len(codes))
    parts = docs.astype(np.int64)
    for _ in range(_ROUNDS):
        before = len(place)
        for size in _GRAMS:
            times = min(
                (max(least, exponent * q) - size + 1) // q for q in range(1, max(least, size) + 1)
            )
            if times < 2 or not len(place):
                continue
            at, number, counts = _grams(codes[place], parts, size)
            covered = np.zeros(len(place) + 1, np.int64)
            often = at[counts[number] >= times]
            np.add.at(covered, often, 1)
            np.add.at(covered, often + size, -1)
            kept = np.cumsum(covered[:-1]) > 0
            place, parts = place[kept], parts[kept]
            if not len(place):
                break
            fresh = np.ones(len(place), bool)
            fresh[1:] = (np.diff(place) != 1) | (np.diff(parts) != 0)
            parts = np.cumsum(fresh) - 1
            long_ = np.bincount(parts)[parts] >= least
            place, parts = place[long_], parts[long_]
        if len(place) == before or not len(place):
            break
    return place, parts


def find_runs(codes: np.ndarray, docs: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Rows (place, length, period) of all runs, by place and period; no run crosses ``docs``."""
    place, parts = candidates(codes, docs, least, exponent)
    if not len(place):
        return np.zeros((0, 3), np.int64)
    heads = np.flatnonzero(np.diff(parts, prepend=-1))
    bounds = np.append(heads, len(place))
    out, stretches, begins, size = [], [], [], 0

    def flush():
        found = runs_of(stretches, least, exponent)
        found[:, 1] += np.array(begins, np.int64)[found[:, 0]]
        out.append(found[:, 1:])

    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if size and size + high - low > _TREE:
            flush()
            stretches, begins, size = [], [], 0
        stretches.append(codes[place[low:high]])
        begins.append(place[low])
        size += high - low
    flush()
    rows = np.concatenate(out)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def word_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, exponent: int = EXPONENT
) -> DataFrame:
    """key, n_words, runs (array of start, length, period by start, then period), collapsed.

    Words are what stands between space characters and U+0009 to U+000D; a run is a
    stretch of ``least`` words and ``exponent`` times its smallest period or more that no
    word on either side extends. ``collapsed`` has the words joined by one space, without
    those behind the first period of any run. A null or empty text has no words, no runs
    and an empty ``collapsed``. Every row has one row, equal and missing keys too; other
    columns are not read. No shuffle; a text is worked on whole, in memory.
    """
    if exponent < 2:
        raise ValueError("two Lyndon tables find runs of an exponent of two or more")
    run = "array<struct<start: long, length: long, period: long>>"
    field = docs.select(F.col(key).alias("key")).schema["key"]
    schema = T.StructType(
        [field, T.StructField("n_words", T.LongType()), T.StructField("runs", T._parse_datatype_string(run)),
         T.StructField("collapsed", T.StringType())]
    )

    def detect(batches):
        for batch in slices(batches, "text"):
            raw, offsets = text_bytes(batch.column(1))
            words = Words(raw, offsets, _BYTES)
            codes, _ = words.distinct()
            counts = words.counts
            doc = np.repeat(np.arange(batch.num_rows), np.diff(counts))
            found = find_runs(codes, doc, least, exponent)
            owner = doc[found[:, 0]]
            starts = found[:, 0] - counts[owner]
            struct = pa.StructArray.from_arrays(
                [pa.array(starts), pa.array(found[:, 1].copy()), pa.array(found[:, 2].copy())], ["start", "length", "period"]
            )
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            edge = np.zeros(len(codes) + 1, np.int64)
            np.add.at(edge, found[:, 0] + found[:, 2], 1)
            np.add.at(edge, found[:, 0] + found[:, 1], -1)
            kept = np.cumsum(edge[:-1]) == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(counts).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), struct), _joined(raw, words, doc, kept, batch.num_rows)],
                schema.names,
            )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(detect, schema).withColumnRenamed("key", key)


def _joined(raw: np.ndarray, words: Words, doc: np.ndarray, kept: np.ndarray, rows: int) -> pa.Array:
    """The kept words of each row, joined by one space."""
    starts, lengths, doc = words.starts[kept], words.lengths[kept], doc[kept]
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    # The byte before a word that is not its row's first is white space of the same row.
    begins = starts - ~first
    sizes = lengths + ~first
    taken = np.zeros(len(raw) + 1, np.int8)
    taken[begins] += 1
    taken[starts + lengths] -= 1
    spaced = raw.copy()
    spaced[begins[~first]] = 0x20
    body = spaced[np.cumsum(taken[:-1], dtype=np.int8) > 0]
    bounds = np.zeros(rows + 1, np.int64)
    np.add.at(bounds, doc + 1, sizes)
    return pa.Array.from_buffers(
        pa.large_string(), rows, [None, pa.py_buffer(np.cumsum(bounds)), pa.py_buffer(body)]
    ).cast(pa.string())
