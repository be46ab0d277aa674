"""Removal of repeated substrings by a common-prefix-aware distributed merge sort.

Every 50-byte string of a text holds 19 strings of 32 bytes; the one of the least hash
is its anchor, so equal strings have equal anchors at equal places. Anchors that occur in
one document alone cannot belong to a repeated string and are left out: the chunks of the
texts exchange packed, sorted hashes and get one bit for each back.

The suffixes at the anchors that are left are sorted inside each chunk. Sorted runs are
exchanged front-coded, that is, without what each suffix has in common with the one
before it, and merged by loser trees that keep the length of the prefix common with the
last output: two suffixes are compared only where those lengths tie, and a suffix after
its predecessor of the same run not at all. In the merged order, the suffixes that agree
on the right part of a string are neighbours; among those that agree on its left part too
the smallest document keeps it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize
from .common import frequent_keys, join_facts, slices, text_bytes, written

LENGTH = 50
ANCHOR = 32
#: Strings of LENGTH bytes begin at most so many bytes before their anchor.
LEFT = LENGTH - ANCHOR
CHUNK_BYTES = 4 << 20
_HASH_BITS, _PLACE_BITS = 44, 20
_BLOCK = 1 << _PLACE_BITS
#: Hashes in one task of the first exchange, and suffixes in one task of the second, as
#: expected for texts of which a fifth is repeated.
_HASHES, _SUFFIXES = 1_500_000, 150_000
_NO_ID = 2**63 - 1
_M = 0x9E3779B97F4A7C15


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base % 2**64, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_P, _Q = _powers(_M, _BLOCK + 1), _powers(pow(_M, -1, 2**64), _BLOCK + 1)


def _least(raw: np.ndarray) -> np.ndarray:
    """For each string of LENGTH bytes of at most one block: hash and place of its anchor."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * _P[: len(raw)], out=sums[1:])
        h = sums[ANCHOR:] - sums[:-ANCHOR]
        h *= _Q[: len(h)]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h >>= np.uint64(_PLACE_BITS)
    h <<= np.uint64(_PLACE_BITS)
    h |= np.arange(len(h), dtype=np.uint64)
    width, want = 1, LEFT + 1
    while width < want:
        step = min(width, want - width)
        h = np.minimum(h[:-step], h[step:])
        width += step
    return h


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = a * np.uint64(_M) ^ b
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return z ^ (z >> np.uint64(27))


def anchors(raw: np.ndarray, offsets: np.ndarray):
    """Place and hash of all anchors, and the least and greatest distance of the strings'
    beginnings before each. Strings lie inside one text."""
    total = len(raw)
    ends = np.zeros(total + LENGTH + 1, np.int8)
    # Beginnings that are less than LENGTH bytes before the end of their text.
    first = np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1)
    np.add.at(ends, first, 1)
    np.add.at(ends, offsets[1:], -1)
    valid = np.cumsum(ends[:total], dtype=np.int32) == 0
    place, code, begin = [], [], []
    step = _BLOCK - LENGTH
    for at in range(0, max(0, total - LENGTH + 1), step):
        block = raw[at : at + _BLOCK]
        if len(block) < LENGTH:
            break
        least = _least(block)[:step]
        here = np.flatnonzero(valid[at : at + len(least)])
        least = least[here]
        place.append((least & np.uint64(_BLOCK - 1)).astype(np.int64) + at)
        code.append(least >> np.uint64(_PLACE_BITS))
        begin.append(here + at)
    if not place:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    place, code, begin = map(np.concatenate, (place, code, begin))
    heads = np.flatnonzero(np.diff(place, prepend=-1) != 0)
    lasts = np.append(heads[1:], len(place)) - 1
    where = place[heads] if len(heads) else place
    if not len(heads):
        return where, code, where, where
    # Hashes of anchors are least ones, and so small; mixed once more they spread evenly.
    code = _mixed(code[heads], np.uint64(LENGTH)) >> np.uint64(_PLACE_BITS)
    return where, code, where - begin[lasts], where - begin[heads]


class Chunk:
    """Texts one behind the other with their documents, and their anchors."""

    def __init__(self, row: dict, buckets: int):
        self.docs = np.frombuffer(row["docs"], np.int64)
        sizes = np.frombuffer(row["sizes"], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=max(1, int(self.offsets[-1])))
        self.raw = np.frombuffer(data, np.uint8)
        self.place, self.code, self.low, self.high = anchors(self.raw, self.offsets)
        self.text = np.searchsorted(self.offsets, self.place, "right") - 1
        self.buckets = buckets

    def distinct(self):
        """Sorted distinct hashes, which of them are in several documents, the number of
        each anchor's hash, and the borders of the buckets."""
        codes, number = np.unique(self.code, return_inverse=True)
        doc = self.docs[self.text]
        low = np.full(len(codes), _NO_ID, np.int64)
        high = np.full(len(codes), -(2**63), np.int64)
        np.minimum.at(low, number, doc)
        np.maximum.at(high, number, doc)
        edges = [(b << _HASH_BITS) // self.buckets for b in range(self.buckets + 1)]
        borders = np.searchsorted(codes, np.array(edges, np.uint64))
        return codes, low != high, number, borders


def _hashes(buckets: int):
    """Of each chunk, its distinct hashes by bucket."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                codes, several, _, borders = Chunk(row, buckets).distinct()
                out = {"bucket": [], "chunk": [], "codes": [], "several": []}
                for b in range(buckets):
                    part = slice(borders[b], borders[b + 1])
                    if borders[b] < borders[b + 1]:
                        out["bucket"].append(b)
                        out["chunk"].append(row["chunk"])
                        out["codes"].append(_delta(codes[part]))
                        out["several"].append(np.packbits(several[part]).tobytes())
                yield pa.RecordBatch.from_pydict(
                    out,
                    pa.schema(
                        [("bucket", pa.int32()), ("chunk", pa.int64()), ("codes", pa.binary()), ("several", pa.binary())]
                    ),
                )

    return run


def _rows(batch) -> Iterator[dict]:
    """Rows one by one, so that only one chunk is unpacked at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _delta(codes: np.ndarray) -> bytes:
    """Sorted numbers as differences of four bytes, or of eight where those are too short."""
    steps = np.diff(codes)
    if len(steps) and steps.max() >= 1 << 32:
        return b"8" + codes.tobytes()
    return b"4" + codes[:1].tobytes() + steps.astype(np.uint32).tobytes()


def _undelta(data: bytes) -> np.ndarray:
    if data[:1] == b"8":
        return np.frombuffer(data, np.uint64, offset=1)
    first = np.frombuffer(data, np.uint64, 1, offset=1)
    steps = np.frombuffer(data, np.uint32, offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([first, steps]), dtype=np.uint64)


def _shared(rows: pa.Table) -> pa.Table:
    """One bit for each hash of each chunk: it occurs in several documents."""
    lists = [_undelta(x.as_py()) for x in rows["codes"]]
    sizes = [len(x) for x in lists]
    codes = np.concatenate(lists)
    several = np.concatenate(
        [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n) for x, n in zip(rows["several"], sizes)]
    ).astype(bool)
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    mark = several[order]
    mark[1:] |= same
    mark[:-1] |= same
    # A hash that several documents of one chunk have is shared in every chunk; with two
    # chunks it already is.
    several[order] = mark
    ends = np.cumsum(sizes)
    bits = [np.packbits(several[e - n : e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table(
        {"chunk": rows["chunk"], "bucket": rows["bucket"], "bits": pa.array(bits, pa.binary())},
        schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())]),
    )


def settle(common, left, masks, docs):
    """Which strings at sorted suffixes a smaller document has, and who keeps each.

    ``common``: bytes that each suffix has in common with the one before it. ``left``: the
    LEFT bytes before each. Bit j of a mask stands for the string that begins j bytes
    before the suffix. Returns two masks per suffix: strings that also begin in a smaller
    document among these, and strings that begin in no smaller one.
    """
    gone = np.zeros(len(docs), np.uint32)
    first = np.zeros(len(docs), np.uint32)
    hash_ = np.zeros(len(docs), np.uint64)
    for j in range(LEFT + 1):
        if j:
            hash_ = _mixed(hash_, left[:, LEFT - j].astype(np.uint64) + np.uint64(1))
        here = np.flatnonzero(masks >> np.uint32(j) & np.uint32(1))
        if not len(here):
            continue
        block = np.cumsum(common < LENGTH - j).astype(np.uint64)[here]
        key = _mixed(hash_[here], block)
        order = np.lexsort((docs[here], key))
        key, doc = key[order], docs[here][order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        bit = np.uint32(1 << j)
        gone[here[order[doc > least]]] |= bit
        first[here[order[doc == least]]] |= bit
    return gone, first


class Suffixes:
    """The suffixes of a chunk at shared anchors, sorted, with what the chunk settles itself."""

    def __init__(self, row: dict, buckets: int):
        chunk = self.chunk = Chunk(row, buckets)
        codes, _, number, borders = chunk.distinct()
        shared = np.zeros(len(codes), bool)
        for part in row["bits"] or ():
            a, b = borders[part["bucket"]], borders[part["bucket"] + 1]
            shared[a:b] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=b - a)
        dropped = np.zeros(len(chunk.docs), bool)
        dropped[np.array(row["dropped"] or [], np.int64)] = True
        self.dropped = dropped
        used = np.flatnonzero(shared[number] & ~dropped[chunk.text]) if len(number) else number
        place = chunk.place[used]
        padded = np.concatenate([np.zeros(LEFT, np.uint8), chunk.raw, np.zeros(LENGTH + 8, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, LEFT + LENGTH + 6)
        around = view[place]  # left part, suffix, and padding to whole words
        words = np.ascontiguousarray(around[:, LEFT:]).view(">u8")
        order = np.lexsort([words[:, k] for k in range(words.shape[1] - 1, -1, -1)])
        # The last word has bytes beyond the suffix; they only refine the order.
        self.used, self.place = used[order], place[order]
        self.left = around[order, :LEFT]
        self.right = around[order, LEFT : LEFT + LENGTH]
        self.docs = chunk.docs[chunk.text[self.used]]
        self.code = chunk.code[self.used]
        ones = (np.uint64(1) << (chunk.high[self.used] + 1).astype(np.uint64)) - np.uint64(1)
        ones &= ~((np.uint64(1) << chunk.low[self.used].astype(np.uint64)) - np.uint64(1))
        self.common = _common(self.right)
        self.gone, self.first = settle(self.common, self.left, ones.astype(np.uint32), self.docs)


def _common(right: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the row before it; 0 for the first."""
    out = np.zeros(len(right), np.int64)
    if len(right) > 1:
        differs = right[1:] != right[:-1]
        out[1:] = np.where(differs.any(1), differs.argmax(1), right.shape[1])
    return out


def _runs(buckets: int, ranges: int):
    """Front-coded sorted runs of each chunk, one for each range of anchor hashes."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for row in _rows(batch):
                s = Suffixes(row, buckets)
                sent = np.flatnonzero(s.first)
                group = (s.code[sent] * np.uint64(ranges) >> np.uint64(_HASH_BITS)).astype(np.int64)
                by_range = np.argsort(group, kind="stable")
                sent, group = sent[by_range], group[by_range]
                heads = np.flatnonzero(np.diff(group, prepend=-1))
                out = {"range": [], "chunk": [], "n": [], "run": []}
                for a, b in zip(heads, [*heads[1:], len(sent)]):
                    rows = sent[a:b]
                    common = _common(s.right[rows])
                    tails = s.right[rows][np.arange(LENGTH) >= common[:, None]]
                    parts = [
                        common.astype(np.uint8), s.first[rows], rows.astype(np.uint32), s.docs[rows],
                        s.left[rows].T, tails,
                    ]
                    out["range"].append(int(group[a]))
                    out["chunk"].append(row["chunk"])
                    out["n"].append(len(rows))
                    out["run"].append(packer.compress(b"".join(p.tobytes() for p in parts)))
                yield pa.RecordBatch.from_pydict(
                    out,
                    pa.schema([("range", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("run", pa.binary())]),
                )

    return run


def _unpacked(data: bytes, n: int):
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    at = 0

    def take(kind, count):
        nonlocal at
        size = np.dtype(kind).itemsize * count
        at += size
        return np.frombuffer(raw[at - size : at].tobytes(), kind)

    common, masks, rows, docs = take(np.uint8, n), take(np.uint32, n), take(np.uint32, n), take(np.int64, n)
    left = take(np.uint8, n * LEFT).reshape(LEFT, n).T
    return common.astype(np.int64), masks, rows, docs, left, raw[at:]


def _keys(common: np.ndarray, tails: np.ndarray) -> list[int]:
    """Suffixes of a front-coded run as whole numbers of LENGTH bytes."""
    out, data, at, last = [], tails.tobytes(), 0, bytes(LENGTH)
    for shared in common.tolist():
        end = at + LENGTH - shared
        last = last[:shared] + data[at:end]
        out.append(int.from_bytes(last, "big"))
        at = end
    return out


def merge(runs: list[list[int]], commons: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs of LENGTH-byte numbers by a loser tree.

    ``commons`` has the bytes in common with the element before, in each run. Returns the
    run of each output, and the bytes it has in common with the output before it. Each
    waiting element keeps the length of its common prefix with the last output (or with
    the element that beat it); the longer one wins without a look at the elements.
    """
    count = 1
    while count < len(runs):
        count *= 2
    key: list[int] = [run[0] if run else 0 for run in runs] + [0] * (count - len(runs))
    have = [0 if run else -1 for run in runs] + [-1] * (count - len(runs))
    at = [0] * count
    loser = [0] * count
    # First round: everything has nothing in common with what was before.
    winners = list(range(count))
    node = count
    while node > 1:
        node //= 2
        above = []
        for k in range(node):
            a, b = winners[2 * k], winners[2 * k + 1]
            if have[b] > have[a] or (have[a] == have[b] == 0 and key[b] < key[a]):
                a, b = b, a
            if have[a] >= 0 and have[b] >= 0:
                have[b] = LENGTH - (((key[a] ^ key[b]).bit_length() + 7) >> 3)
            loser[node + k] = b
            above.append(a)
        # A winner meets the next one with nothing in common again.
        winners = above
    out, shared = [], []
    w = winners[0]
    own = have[w]
    while own >= 0:
        out.append(w)
        shared.append(own)
        i = at[w] = at[w] + 1
        if i < len(runs[w]):
            key[w] = runs[w][i]
            own = commons[w][i]
        else:
            own = -1
        have[w] = own
        node = (w + count) >> 1
        while node:
            o = loser[node]
            other = have[o]
            if other > own:
                loser[node], w, own = w, o, other
            elif other == own and own >= 0:
                x, y = key[w], key[o]
                length = LENGTH - (((x ^ y).bit_length() + 7) >> 3)
                if y < x or (x == y and o < w):
                    have[w] = length
                    loser[node], w = w, o
                else:
                    have[o] = length
            node >>= 1
    return out, shared


def _merged(rows: pa.Table) -> pa.Table:
    """Strings of each chunk that also begin in a smaller document of another chunk."""
    rows = rows.sort_by("chunk")
    parts = [_unpacked(x.as_py(), n) for x, n in zip(rows["run"], rows["n"].to_pylist())]
    runs = [_keys(p[0], p[5]) for p in parts]
    source, common = merge(runs, [p[0].tolist() for p in parts])
    source = np.array(source, np.int64)
    sizes = np.array([len(r) for r in runs])
    # Within a run the order stays: the k-th output of a run is its k-th element.
    by_run = np.argsort(source, kind="stable")
    where = np.empty(len(source), np.int64)
    where[by_run] = np.arange(len(source))
    masks, entry, docs = (np.concatenate([p[k] for p in parts])[where] for k in (1, 2, 3))
    left = np.concatenate([p[4] for p in parts])[where]
    gone, _ = settle(np.array(common, np.int64), left, masks, docs)
    hit = np.flatnonzero(gone)
    hit = hit[np.argsort(source[hit], kind="stable")]
    borders = np.searchsorted(source[hit], np.arange(len(sizes) + 1))
    chunks, data = [], []
    for k, chunk in enumerate(rows["chunk"].to_pylist()):
        own = hit[borders[k] : borders[k + 1]]
        if len(own):
            chunks.append(chunk)
            data.append(np.stack([entry[own], gone[own]]).tobytes())
    return pa.table(
        {"chunk": chunks, "hits": data}, schema=pa.schema([("chunk", pa.int64()), ("hits", pa.binary())])
    )


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_RESULT = T.StructType(
    [
        T.StructField("doc", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", _SPANS),
        T.StructField("kept", T.BinaryType()),
    ]
)


def _removed(buckets: int):
    """Removed spans and remaining bytes of each document of each chunk."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                s = Suffixes(row, buckets)
                chunk, gone = s.chunk, s.gone.copy()
                for hits in row["hits"] or ():
                    entry, masks = np.frombuffer(hits, np.uint32).reshape(2, -1)
                    gone[entry] |= masks
                edge = np.zeros(len(chunk.raw) + LENGTH + 1, np.int32)
                for j in range(LEFT + 1):
                    begin = s.place[gone >> np.uint32(j) & np.uint32(1) == 1] - j
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + LENGTH, -1)
                covered = np.cumsum(edge[: len(chunk.raw)]) > 0
                yield from _documents(chunk, covered, s.dropped)

    return run


def _documents(chunk: Chunk, covered: np.ndarray, dropped: np.ndarray):
    o = chunk.offsets
    for at in range(0, len(chunk.docs), 256):
        spans, kept = [], []
        numbers = range(at, min(at + 256, len(chunk.docs)))
        for d in numbers:
            size = int(o[d + 1] - o[d])
            mask = covered[o[d] : o[d + 1]]
            if dropped[d] and size >= LENGTH:
                mask = np.ones(size, bool)
            turns = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])])
            raw = chunk.raw[o[d] : o[d + 1]]
            kept.append((raw[~mask] if len(turns) else raw).tobytes())
        docs = [None if chunk.docs[d] == _NO_ID else int(chunk.docs[d]) for d in numbers]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(docs, pa.int64()),
                pa.array(np.diff(o)[at : at + 256]),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            names=["doc", "n_bytes", "spans", "kept"],
        )


def _chunks(batches):
    """Texts in chunks of about CHUNK_BYTES, compressed."""
    packer = zstandard.ZstdCompressor(level=6)
    for batch in slices(batches, "text", CHUNK_BYTES):
        get = lambda name: batch.column(batch.schema.get_field_index(name))
        raw, offsets = text_bytes(get("text"))
        yield pa.RecordBatch.from_pydict(
            {
                "docs": [get("doc").to_numpy().astype(np.int64).tobytes()],
                "sizes": [np.diff(offsets).astype(np.int64).tobytes()],
                "h1": [get("h1").to_pylist()],
                "h2": [get("h2").to_pylist()],
                "ids": [get("doc").to_pylist()],
                "texts": [packer.compress(raw.tobytes())],
            },
            pa.schema(
                [
                    ("docs", pa.binary()), ("sizes", pa.binary()), ("h1", pa.list_(pa.int64())),
                    ("h2", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("texts", pa.binary()),
                ]
            ),
        )


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, n_bytes, spans (start, end in bytes) and kept (the remaining bytes) of all rows.

    Every byte goes that is covered by a string of LENGTH bytes which also begins in a row
    of a smaller id; overlaps count, and strings are judged on the input. Null and empty
    texts, and those shorter than LENGTH bytes, lose nothing. Rows of equal ids never lose
    anything to each other; a row without id counts as one of the largest. An empty table
    gives no rows.
    """
    long = F.octet_length(text) >= LENGTH
    base = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.when(long, F.xxhash64(text)).alias("h1"),
        F.when(long, F.xxhash64(text, F.lit(1))).alias("h2"),
        F.col(text).alias("text"),
    )
    shape = "docs binary, sizes binary, h1 array<long>, h2 array<long>, ids array<long>, texts binary"
    chunks = written(
        base.mapInArrow(_chunks, shape).withColumn("chunk", F.monotonically_increasing_id()), "chunks"
    )
    # Whole texts that a smaller document has too need no sorting.
    # Those without a hash are too short to lose anything.
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "h1", "h2")).alias("at", "x"))
    rows = rows.select("chunk", "at", "x.*").filter("h1 is not null")
    first = rows.groupBy("h1", "h2").agg(F.min("ids").alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.filter("n > 1"), "copied-texts")
    hot = frequent_keys(first, ["h1", "h2"], "n")
    copies = join_facts(rows, first, ["h1", "h2"], hot).filter("ids > first")
    dropped = copies.groupBy("chunk").agg(F.collect_list(F.col("at").cast("long")).alias("dropped"))
    total = docs.select(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    expected = total * 2 // (LEFT + 2)
    buckets = max(16, expected // _HASHES)
    ranges = max(64, expected // 5 // _SUFFIXES)
    bare = chunks.select("chunk", "docs", "sizes", "texts")
    hashes = bare.mapInArrow(_hashes(buckets), "bucket int, chunk long, codes binary, several binary")
    bits = hashes.groupBy("bucket").applyInArrow(_shared, "chunk long, bucket int, bits binary")
    bits = bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits"))
    known = materialize(bits.join(dropped, "chunk", "full"), "shared-anchors")
    informed = bare.join(known, "chunk", "left")
    runs = informed.mapInArrow(_runs(buckets, ranges), "range int, chunk long, n int, run binary")
    hits = runs.groupBy("range").applyInArrow(_merged, "chunk long, hits binary")
    hits = materialize(hits.groupBy("chunk").agg(F.collect_list("hits").alias("hits")), "repeated")
    return informed.join(hits, "chunk", "left").mapInArrow(_removed(buckets), _RESULT)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every document."""
    found = remove_repeated(docs)
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
