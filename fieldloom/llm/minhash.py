"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A sketch has ``bins`` coordinates. In every round, each element of the set is thrown into
one bin by a fresh hash; once ``bins`` rounds are over, round ``bins + i`` throws all
elements into bin i, so every coordinate is filled. A bin keeps the least value of the
first round that reached it. Equal coordinates of two sketches are as likely as the
Jaccard similarity of the sets, and concentrate like independent ones. Bands of
coordinates make candidates, and whole sets decide on them.

Documents with equal sets are one class from the start. In every bucket of a band, all
classes are first compared with one of them, in several rounds; the classes that no
comparison has yet brought together with the rest of their bucket are then compared with
all of it, in blocks. So no link between different texts depends on a choice of centres.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import materialize
from .common import frequent_keys, join_facts, slices, text_bytes, word_codes
from .components import components

#: Chance at most that no band of two sets at the threshold agrees, and coordinates at most.
MISS, MOST_BINS = 1e-7, 360
#: Rounds in which every bucket is compared with one of its classes.
ROUNDS = 2
# Classes in one block of the last comparison.
BLOCK = 200
#: Ids sent to every executor at most, at eight bytes each. More are joined by shuffle.
BROADCAST_IDS = 2_000_000
SLICE_BYTES = 2 << 20


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows of each: the longest bands that miss a pair at the threshold hardly ever."""
    best = (MOST_BINS, 1)
    for rows in range(1, 17):
        agree = (percent / 100) ** rows
        bands = int(np.ceil(np.log(MISS) / np.log1p(-agree))) if agree < 1 else 1
        if bands * rows <= MOST_BINS:
            best = (bands, rows)
    return best


def _word_bytes() -> np.ndarray:
    """Byte to lower-cased word byte; 0 for white space. Byte 0 itself is a word byte, for
    which 0xFF stands, as UTF-8 has it nowhere."""
    out = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
    out[0] = 0xFF
    out[0x20] = 0
    out[0x09:0x0E] = 0
    return out


_WORD = _word_bytes()


# Rows without id are numbered from here on; ids are less.
_STAND_IN = 1 << 62


def _mix(values: np.ndarray, key: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = values + np.uint64(key & (2**64 - 1))
        z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
        return z ^ (z >> np.uint64(32))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int):
    """Sorted distinct hashes of all runs of ``words`` words per text, and n + 1 offsets.

    A text of fewer words, but not none, has its whole sequence as the one element.
    """
    codes, counts = word_codes(raw, offsets, _WORD)
    sizes = np.diff(counts)
    texts = len(sizes)
    runs = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    total = int(runs.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    of = np.repeat(np.arange(texts), runs)
    at = np.arange(total) - np.repeat(np.cumsum(runs) - runs, runs) + counts[:-1][of]
    length = np.minimum(words, sizes)[of]
    with np.errstate(over="ignore"):
        hashes = np.zeros(total, np.uint64)
        for k in range(words):
            here = length > k
            part = np.where(here, codes[np.minimum(at + k, len(codes) - 1)], np.uint64(0))
            hashes = np.where(here, _mix(hashes * np.uint64(0x9E3779B97F4A7C15) + part, k + 1), hashes)
    order = np.argsort(hashes, kind="stable")
    # Texts of a slice are few, so that the second, stable sort is a counting sort.
    by_text = of[order].astype(np.uint16) if texts < 1 << 16 else of[order]
    order = order[np.argsort(by_text, kind="stable")]
    hashes, of = hashes[order], of[order]
    new = np.ones(total, bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=texts))])


def sketches(hashes: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """The fast similarity sketch of each set, a row of ``bins`` numbers; empty sets stay 0."""
    sets = len(offsets) - 1
    empty = np.uint64(2**64 - 1)
    out = np.full(sets * bins, empty, np.uint64)
    sizes = np.diff(offsets)
    of = np.repeat(np.arange(sets), sizes)
    left = np.where(sizes > 0, bins, 0)
    elements = hashes
    for turn in range(2 * bins):
        # Sets that are filled take no further part.
        if turn:
            active = left[of] > 0
            if not active.all():
                of, elements = of[active], elements[active]
        if not len(of):
            break
        value = _mix(elements, (turn + 1) * 0x9E3779B97F4A7C15)
        if turn < bins:
            target = ((value >> np.uint64(40)) * np.uint64(bins)) >> np.uint64(24)
            target = of * bins + target.astype(np.int64)
        else:
            target = of * bins + (turn - bins)
        # A later round never replaces what an earlier one has left, and the least of
        # this round stays; the low bits alone are compared, the round goes on top.
        fresh = out[target] == empty
        target, value = target[fresh], _mix(value[fresh], turn) >> np.uint64(16)
        value |= np.uint64(turn) << np.uint64(48)
        np.minimum.at(out, target, value)
        reached = np.unique(target)
        left = left - np.bincount(reached // bins, minlength=sets)
    out[out == empty] = 0
    return out.reshape(sets, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    out = np.zeros((len(sketch), bands), np.uint64)
    with np.errstate(over="ignore"):
        out += np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        for r in range(rows):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + sketch[:, r::rows][:, :bands])
    return out


def _list_array(values: np.ndarray, width: int) -> pa.Array:
    ends = np.arange(0, values.size + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1).view(np.int64)))


class _Signatures:
    def __init__(self, words, text, percent):
        self.words, self.text = words, text
        self.bands, self.rows = banding(percent)

    def __call__(self, batches):
        for batch in slices(batches, self.text, SLICE_BYTES):
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            hashes, offsets = shingle_sets(*text_bytes(column(self.text)), self.words)
            sizes = np.diff(offsets)
            # Two sums of hashes name the set.
            one = _sums(_mix(hashes, 11), offsets)
            two = _sums(_mix(hashes, 23), offsets)
            sketch = sketches(hashes, offsets, self.bands * self.rows)
            keys = band_keys(sketch, self.bands, self.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    column("__id"),
                    column("__text_hash"),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    _list_array(keys, self.bands),
                ],
                names=["id", "text_hash", "n", "d1", "d2", "bands"],
            )


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    with np.errstate(over="ignore"):
        return ends[offsets[1:]] - ends[offsets[:-1]]


_SIGNATURE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


class _Sets:
    """Whole sets of the texts whose ids are wanted, or of all."""

    def __init__(self, words, wanted):
        self.words, self.wanted = words, wanted

    def __call__(self, batches):
        wanted = None if self.wanted is None else self.wanted.value
        for batch in slices(batches, "__text", SLICE_BYTES):
            ids = batch.column(batch.schema.get_field_index("id")).to_numpy(zero_copy_only=False)
            if wanted is not None:
                at = np.minimum(np.searchsorted(wanted, ids), max(0, len(wanted) - 1))
                hit = wanted[at] == ids if len(wanted) else np.zeros(len(ids), bool)
                if not hit.any():
                    continue
                batch, ids = batch.filter(pa.array(hit)), ids[hit]
            text = batch.column(batch.schema.get_field_index("__text"))
            hashes, offsets = shingle_sets(*text_bytes(text), self.words)
            sets = [hashes[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(sets, pa.binary())], names=["id", "items"]
            )


def _similar(percent: int):
    def run(batches):
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            keep = []
            for x, y in zip(get("items_a"), get("items_b")):
                left = np.frombuffer(x.as_buffer(), np.uint64)
                right = np.frombuffer(y.as_buffer(), np.uint64)
                common = _common(left, right)
                keep.append(100 * common >= percent * (len(left) + len(right) - common))
            yield pa.RecordBatch.from_arrays(
                [get("a"), get("b"), pa.array(keep, pa.bool_())], names=["a", "b", "linked"]
            )

    return run


def _common(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.concatenate([left, right])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _one_table(rows: pa.Table, percent: int) -> pa.Table:
    """Links between different components, from those that ask to those of their block."""
    rows = rows.sort_by([("component", "ascending"), ("id", "ascending"), ("asks", "ascending")])
    ids, component = rows["id"].to_numpy(), rows["component"].to_numpy()
    asks = rows["asks"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["items"].combine_chunks()]
    sizes = np.array([len(s) for s in sets], np.int64)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(int(codes.max(initial=-1)) + 1, np.int64)
    joined: dict[int, int] = {}

    def root(c):
        while joined.get(c, c) != c:
            c = joined[c]
        return c

    found = []
    for i in np.flatnonzero(asks):
        own = codes[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        common = np.add.reduceat(mark[codes], starts)
        mark[own] = 0
        linked = 100 * common >= percent * (sizes[i] + sizes - common)
        for j in np.flatnonzero(linked & ~asks & (component != component[i])):
            a, b = root(int(component[i])), root(int(component[j]))
            if a != b:
                joined[max(a, b)] = min(a, b)
                found.append((int(ids[i]), int(ids[j])))
    return pa.table(
        {"a": [x for x, _ in found], "b": [y for _, y in found]},
        schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]),
    )


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """id, text_hash, n (size of the set) and component for every row of ``docs``.

    Sets are runs of ``words`` words; rows are linked if the intersection has at least
    ``percent`` hundredths of the union. The component is the smallest id reachable,
    the row's own included. Texts without words (null, empty, white space) link with
    nothing. Rows of equal ids may have different texts; they share the id's component.
    Rows without id take part: theirs is the smallest id reachable, or null.
    """
    named = lambda name: F.when(F.col(name) < _STAND_IN, F.col(name)).alias(name)
    found = _numbered_duplicates(docs, words, percent, key, text)
    return found.select(named("id"), "text_hash", "n", named("component"))


def _number(key: str, text: str):
    """The id; of rows without one a number above all ids, by the text."""
    stand_in = F.xxhash64(text).bitwiseAND(_STAND_IN - 1) + F.lit(_STAND_IN)
    return F.coalesce(F.col(key).cast("long"), stand_in)


def _numbered_duplicates(
    docs: DataFrame, words: int, percent: int, key: str, text: str
) -> DataFrame:
    """As ``near_duplicates``, with the numbers of ``_number`` for ids."""
    base = docs.select(
        _number(key, text).alias("__id"),
        F.xxhash64(text).alias("__text_hash"),
        F.col(text).alias("__text"),
    )
    signed = materialize(base.mapInArrow(_Signatures(words, "__text", percent), _SIGNATURE), "signatures")
    # Documents of equal sets are one class, named by its smallest id.
    classes = materialize(
        signed.filter("n > 0")
        .groupBy("d1", "d2", "n")
        .agg(F.min("id").alias("rep"), F.first("bands").alias("bands")),
        "classes",
    )
    rows = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    shared = materialize(shared, "bucket-sizes")
    # A bucket may hold a third of all classes; no task gets all of it.
    hot = frequent_keys(shared, ["bucket"], "m")
    crowded = materialize(join_facts(rows, shared, ["bucket"], hot), "buckets")
    # A class that meets many others is likely to resemble them: it makes a good centre.
    met = crowded.groupBy("rep").agg(F.sum("m").alias("met"))
    crowded = materialize(crowded.join(met, "rep").select("bucket", "rep", "met"), "buckets")
    fetch = _Fetch(base, words)
    parts = None
    for _ in range(ROUNDS):
        best = F.max(F.struct(F.col("met"), (-F.col("rep")).alias("back")))
        centers = crowded.groupBy("bucket").agg((-best["back"]).alias("center"))
        crowded = materialize(join_facts(crowded, centers, ["bucket"], hot), "buckets")
        pairs = crowded.filter("rep <> center").select("center", "rep").distinct()
        parts = _grown(parts, _verified(fetch, pairs, percent))
        # What was compared with all others of its bucket is done with; so is a bucket
        # whose other members have all come together.
        rest = crowded.filter("rep <> center").select("bucket", "rep", "met")
        rest = (
            rest.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep"))
        )
        open_ = (
            rest.groupBy("bucket")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .filter("low <> high")
            .select("bucket")
        )
        crowded = materialize(join_facts(rest, open_, ["bucket"], hot), "buckets")
        if crowded.isEmpty():
            break
        left, crowded = crowded, crowded.drop("component")
    else:
        parts = _grown(parts, _compare_blocks(fetch, left, hot, percent))
    found = classes.select("d1", "d2", F.col("n").alias("size"), "rep").join(
        parts.withColumnRenamed("node", "rep"), "rep", "left"
    ).select("d1", "d2", "size", F.coalesce("component", "rep").alias("component"))
    same = (
        (signed["d1"] == found["d1"]) & (signed["d2"] == found["d2"]) & (signed["n"] == found["size"])
    )
    return signed.join(found, same, "left").select(
        "id", "text_hash", "n", F.coalesce("component", "id").alias("component")
    )


def _grown(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of new links together with what earlier ones have connected."""
    if parts is not None:
        links = links.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return components(links)


class _Fetch:
    """Whole sets of the classes that are to be compared, made from the texts again."""

    def __init__(self, base: DataFrame, words: int):
        self.base = base.select(F.col("__id").alias("id"), "__text")
        self.words = words

    def __call__(self, ids: DataFrame) -> DataFrame:
        """id, items for the distinct ``id`` in ``ids``."""
        count = ids.count()
        schema = "id long, items binary"
        if count <= BROADCAST_IDS:
            wanted = np.sort(np.array([row[0] for row in ids.toLocalIterator()], np.int64))
            sent = ids.sparkSession.sparkContext.broadcast(wanted)
            return self.base.mapInArrow(_Sets(self.words, sent), schema)
        return self.base.join(ids, "id").mapInArrow(_Sets(self.words, None), schema)


def _verified(fetch: _Fetch, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (center, rep) that are similar enough, as links (a, b)."""
    pairs = materialize(pairs, "pairs")
    ids = materialize(
        pairs.select(F.col("center").alias("id")).unionByName(pairs.select(F.col("rep").alias("id"))).distinct(),
        "compared",
    )
    sets = materialize(fetch(ids), "sets")
    joined = (
        pairs.withColumnsRenamed({"center": "a", "rep": "b"})
        .join(sets.withColumnsRenamed({"id": "b", "items": "items_b"}), "b")
        .join(sets.withColumnsRenamed({"id": "a", "items": "items_a"}), "a")
    )
    checked = joined.mapInArrow(_similar(percent), "a long, b long, linked boolean")
    return materialize(checked.filter("linked").select("a", "b"), "similar")


def _compare_blocks(fetch: _Fetch, crowded: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Links between components of each bucket, all its members compared in blocks.

    Members outside the bucket's largest component are compared with all members; those
    inside it need no comparison with each other.
    """
    ids = materialize(crowded.select(F.col("rep").alias("id")).distinct(), "compared")
    sets = materialize(fetch(ids), "sets")
    groups = crowded.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size"))
    sizes = groups.groupBy("bucket").agg(
        F.max(F.struct("size", "component")).alias("most"), F.sum("size").alias("m")
    )
    count = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    placed = join_facts(
        crowded.select("bucket", F.col("rep").alias("id"), "component"),
        sizes.select(
            "bucket",
            F.col("most.component").alias("largest"),
            count(F.col("m")).alias("all"),
            count(F.col("m") - F.col("most.size")).alias("asking"),
        ),
        ["bucket"],
        hot,
    )
    own = lambda blocks: F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    names = ["bucket", "i", "j", "id", "component", "asks"]
    held = placed.select("*", own("all").alias("i"), every("asking").alias("j"), F.lit(False).alias("asks"))
    asking = placed.filter("component <> largest").select(
        "*", own("asking").alias("j"), every("all").alias("i"), F.lit(True).alias("asks")
    )
    return materialize(
        held.select(*names)
        .unionByName(asking.select(*names))
        .join(sets, "id")
        .groupBy("bucket", "i", "j")
        .applyInArrow(lambda rows: _one_table(rows, percent), "a long, b long"),
        "similar",
    )


def group_documents(docs: DataFrame, words: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    found = near_duplicates(docs, words, percent)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def remove_near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One document of each group, that of the smallest id, with the columns of ``docs``.

    Rows that repeat id and text stay once. Of a group without any id one document stays;
    rows without id whose texts have no words all stay.
    """
    found = materialize(_numbered_duplicates(docs, words, percent, key, text), "groups")
    gone = found.filter(F.col("id") != F.col("component"))
    gone = gone.select(F.col("id").alias("__i"), F.col("text_hash").alias("__h")).distinct()
    again = (
        found.filter((F.col("id") < _STAND_IN) | (F.col("n") > 0)).groupBy(F.col("id").alias("__i"), F.col("text_hash").alias("__h"))
        .count().filter("count > 1").drop("count")
    )
    keyed = docs.withColumn("__hash", F.xxhash64(text)).withColumn("__number", _number(key, text))
    same = lambda other: (F.col("__number") == other["__i"]) & (F.col("__hash") == other["__h"])
    kept = keyed.join(_small(gone), same(gone), "left_anti")
    if again.isEmpty():
        return kept.drop("__hash", "__number")
    once = kept.join(again, same(again), "left_semi").dropDuplicates(["__number", "__hash"])
    return kept.join(again, same(again), "left_anti").unionByName(once).drop("__hash", "__number")


def _small(frame: DataFrame) -> DataFrame:
    """A hint to broadcast, given only to a table of a checked size."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_IDS // 4 else frame
