"""One-hot dictionaries, one-hot vectors and hashed features."""

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.digest import check_buckets, digest_bucket
from ..functions.vectors import sparse_vector, stored_vector, vector_sparsity
from ..storage import materialize, materialize_vectors

# A dictionary is sent to every executor up to this size, estimated from its
# category texts plus the fixed cost of an entry. Larger ones are joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
_ENTRY_BYTES = 128
# Rows with more categories than this are encoded through the shuffled join.
MAX_CHAINED_JOINS = 64
_JOINS_PER_STAGE = 8
_MAX_VECTOR = 2**31 - 1
# A pair is hot when it holds more of the pairs than this share of what a partition of
# the shuffled join gets on average, so there are at most two hot pairs per partition.
HOT_SHARE = 0.5
# Counters per partition that pairs are first counted in, and fewest counters.
_COUNTERS, _LEAST_COUNTERS = 8, 4096

# Fixed value: the usual number of hash buckets.
HASH_BUCKETS = 2**15

# monotonically_increasing_id keeps the row's place in its partition in this many low bits.
_PLACE_BITS = 33

_PAIR = ["feature_id", "category"]


def explode_pairs(df: DataFrame, column: str = "feature") -> DataFrame:
    """One row (feature_id, category) per pair, next to the other columns."""
    others = [name for name in df.columns if name != column]
    # A plain explode would have the optimizer filter out empty arrays before it,
    # which builds the array twice where it is not stored but parsed.
    pairs = df.select(*others, F.explode_outer(column).alias("__pair"))
    return pairs.filter(F.col("__pair").isNotNull()).select(
        *others,
        F.col("__pair")["_1"].alias("feature_id"),
        F.col("__pair")["_2"].alias("category"),
    )


def distinct_pairs(df: DataFrame, column: str = "feature") -> DataFrame:
    return explode_pairs(df.select(column), column).distinct()


def category_counts(df: DataFrame, column: str = "feature") -> DataFrame:
    """Number of distinct categories of each feature, in feature order.

    The distinct pairs are counted from a shuffle on the whole pair, so a feature
    with most of the categories is spread over all tasks.
    """
    return (
        distinct_pairs(df, column)
        .groupBy("feature_id")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("feature_id")
    )


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("size"),
        F.coalesce(F.sum(F.octet_length("category")), F.lit(0)).alias("text"),
    ]


@dataclass(frozen=True)
class OneHotDictionary:
    """A table (feature_id, category, idx) with its measured size."""

    frame: DataFrame
    size: int
    bytes: int

    @classmethod
    def of(cls, frame: DataFrame) -> "OneHotDictionary":
        """Measure a table that is already numbered 0..n-1."""
        row = frame.agg(*_measures()).first()
        return cls(frame, row["size"], row["text"] + row["size"] * _ENTRY_BYTES)


def build_dictionary(df: DataFrame, column: str = "feature") -> OneHotDictionary:
    """Number the distinct pairs 0..n-1 in the order (feature_id, category).

    Pairs are sorted by range partitioning, numbered inside each partition, and
    shifted by the sizes of the partitions before it. Only those sizes, one row
    per partition, are ever brought together, and a feature with most of the
    categories is cut into as many ranges as it needs.
    """
    ranges = (
        distinct_pairs(df, column)
        .repartitionByRange(*_PAIR)
        .sortWithinPartitions(*_PAIR)
        .withColumn("__slot", F.monotonically_increasing_id())
    )
    # Range bounds are drawn anew whenever the plan runs, so numbers and sizes
    # have to come from one written run.
    numbered = materialize(ranges, "dictionary").select(
        *_PAIR,
        F.shiftright("__slot", _PLACE_BITS).alias("__range"),
        F.col("__slot").bitwiseAND((1 << _PLACE_BITS) - 1).alias("__place"),
    )
    sizes = numbered.groupBy("__range").agg(*_measures()).orderBy("__range").collect()
    # One row per partition: how many pairs lie in the partitions before it.
    ends = accumulate(row["size"] for row in sizes)
    offsets = df.sparkSession.createDataFrame(
        [(row["__range"], end - row["size"]) for row, end in zip(sizes, ends)],
        "__range long, __before long",
    )
    frame = numbered.join(F.broadcast(offsets), "__range").select(
        *_PAIR, (F.col("__before") + F.col("__place")).alias("idx")
    )
    size = sum(row["size"] for row in sizes)
    return OneHotDictionary(
        frame, size, sum(row["text"] for row in sizes) + size * _ENTRY_BYTES
    )


def _unique_pairs(column: str) -> Column:
    """The pairs of a row, each once.

    Rows of pairwise different features, the usual case, are recognized by their
    short feature numbers and skip the comparison of whole pairs.
    """
    features = F.col(column)["_1"]
    return F.when(
        F.size(F.array_distinct(features)) == F.size(column), F.col(column)
    ).otherwise(F.array_distinct(column))


def _ones(indices: Column) -> Column:
    return F.array_repeat(F.lit(1.0), F.size(indices))


def _with_vector(
    df: DataFrame,
    kept: list[str],
    output: str,
    size: int,
    indices: Column,
    values: Column,
    written: bool,
) -> DataFrame:
    if written:
        stored = df.select(*kept, stored_vector(size, indices, values).alias(output))
        return materialize_vectors(stored, output, "features")
    return df.select(*kept, sparse_vector(size, indices, values).alias(output))


def _widest(df: DataFrame, column: str) -> int:
    return df.agg(F.max(F.size(column))).first()[0] or 0


def _encode_in_row(
    df: DataFrame, dictionary: OneHotDictionary, column: str, kept: list[str], width: int
) -> DataFrame:
    """Look up each position of the array by a broadcast join: no shuffle.

    All joins share one broadcast of the dictionary.
    """
    checked = F.when(F.size(column) <= width, _unique_pairs(column)).otherwise(
        F.raise_error(F.lit(f"a row has more than {width} categories"))
    )
    df = df.select(
        *kept,
        F.when(F.col(column).isNotNull(), checked).alias("__pairs"),
        F.array().cast("array<int>").alias("__found"),
    )
    for start in range(0, width, _JOINS_PER_STAGE):
        places = range(start, min(start + _JOINS_PER_STAGE, width))
        for i in places:
            entry = dictionary.frame.select(
                F.col("feature_id").alias("__f"),
                F.col("category").alias("__c"),
                F.col("idx").cast("int").alias(f"__i{i}"),
            )
            pair = F.get("__pairs", F.lit(i))
            match = (pair["_1"] == F.col("__f")) & (pair["_2"] == F.col("__c"))
            df = df.join(F.broadcast(entry), match, "left").drop("__f", "__c")
        # Collecting what was found ends a stage of generated code, which keeps
        # each within the size that the JVM compiles.
        new = F.array_compact(F.array(*[F.col(f"__i{i}") for i in places]))
        df = df.select(*kept, "__pairs", F.concat("__found", new).alias("__found"))
    return df.select(*kept, F.sort_array("__found").alias("__indices"))


def frequent_pairs(pairs: DataFrame, share: float, counters: int) -> DataFrame:
    """The pairs (feature_id, category) with more than ``share`` of all rows, and no others.

    Rows are counted by a hash of their pair first. No pair is in more rows than its
    counter says, so pairs are counted one by one only where a counter is above the
    limit. Both counts are combined before they are shuffled: a task sends a row for each
    counter, then one for each pair of the few high counters. Pairs with a NULL do not
    count.
    """
    pairs = pairs.select(*_PAIR).dropna()
    pairs = pairs.withColumn("__counter", F.pmod(F.xxhash64(*_PAIR), F.lit(counters)))
    counts = pairs.groupBy("__counter").agg(F.count(F.lit(1)).alias("__n"))
    counts = materialize(counts, "pair-counters")
    limit = (counts.agg(F.sum("__n")).first()[0] or 0) * share
    high = counts.filter(F.col("__n") > limit).select("__counter")
    each = pairs.join(F.broadcast(high), "__counter").groupBy(*_PAIR)
    return each.agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).select(*_PAIR)


def _hot_pairs(exploded: DataFrame, dictionary: OneHotDictionary) -> DataFrame:
    """Frequent pairs with their index, or no index if unknown: at most two per partition."""
    partitions = int(exploded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counters = max(_LEAST_COUNTERS, _COUNTERS * partitions)
    frequent = frequent_pairs(exploded, HOT_SHARE / max(1, partitions), counters)
    hot = materialize(frequent, "frequent-pairs")
    known = dictionary.frame.join(F.broadcast(hot), _PAIR)
    return materialize(hot.join(F.broadcast(known), _PAIR, "left"), "hot-pairs")


def _encode_by_shuffle(
    df: DataFrame, dictionary: OneHotDictionary, column: str, kept: list[str], row_id: str
) -> DataFrame:
    """Join exploded pairs with the dictionary, then regroup them by row.

    Pairs are exploded and written once. Frequent ones, known or not, are counted exactly
    and looked up by broadcast, and missing ones need no look-up, so no join key of the
    shuffle holds more than ``HOT_SHARE`` of an average partition.
    """
    # The constant keeps the struct valid when there is nothing else to carry.
    payload = F.struct(F.lit(0).alias("__"), *[F.col(name) for name in kept if name != row_id])
    exploded = df.select(
        row_id,
        payload.alias("__row"),
        F.posexplode_outer(_unique_pairs(column)).alias("__pos", "__pair"),
    ).select(
        row_id,
        # The row itself travels with its first pair only.
        F.when(F.coalesce("__pos", F.lit(0)) == 0, F.col("__row")).alias("__row"),
        F.col("__pair")["_1"].alias("feature_id"),
        F.col("__pair")["_2"].alias("category"),
    )
    exploded = materialize(exploded, "pairs")
    missing = F.col("feature_id").isNull() | F.col("category").isNull()
    hot = _hot_pairs(exploded, dictionary).withColumn("__hot", F.lit(True))
    marked = exploded.join(F.broadcast(hot), _PAIR, "left")
    settled = F.col("__hot").isNotNull() | missing
    names = [row_id, "__row", "idx"]
    rest = marked.filter(~settled).drop("idx", "__hot")
    # Dictionaries come here that are too large to be sent to every executor.
    by_shuffle = rest.join(dictionary.frame.hint("merge"), _PAIR, "left")
    grouped = (
        marked.filter(settled)
        .select(*names)
        .unionByName(by_shuffle.select(*names))
        .groupBy(row_id)
        .agg(
            F.first("__row", ignorenulls=True).alias("__row"),
            F.sort_array(F.collect_list(F.col("idx").cast("int"))).alias("__indices"),
        )
    )
    columns = [
        F.col(name) if name == row_id else F.col("__row")[name].alias(name) for name in kept
    ]
    return grouped.select(*columns, "__indices")


def _one_hot_indices(
    df: DataFrame,
    dictionary: OneHotDictionary,
    column: str,
    row_id: str | None,
    width: int | None,
    broadcast_bytes: int,
    kept: list[str],
) -> DataFrame:
    """``kept`` and the ascending indices of each row's pairs, as ``__indices``."""
    if dictionary.bytes <= broadcast_bytes:
        if width is None:
            width = _widest(df, column)
        if width <= MAX_CHAINED_JOINS:
            return _encode_in_row(df, dictionary, column, kept, width)
    if row_id is None:
        # Numbers are safe to use once they are written.
        row_id = "__row_id"
        df = materialize(df.withColumn(row_id, F.monotonically_increasing_id()), "rows")
    return _encode_by_shuffle(df, dictionary, column, kept, row_id)


def one_hot_encode(
    df: DataFrame,
    dictionary: OneHotDictionary,
    column: str = "feature",
    output: str = "features",
    row_id: str | None = None,
    width: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep: Sequence[str] | None = None,
    written: bool = False,
) -> DataFrame:
    """Add a sparse vector with 1.0 at the index of each pair of the row.

    Pairs that are not in the dictionary are dropped; the vector is as long as
    the dictionary. A dictionary within ``broadcast_bytes`` is looked up in place.
    A larger one, or a row of very many pairs, is joined by shuffle, and rows are put
    together again by the unique column ``row_id``; without one, they are numbered and
    written first. ``width``, the most pairs in any
    row, is measured if not given. ``keep`` names the columns to keep, all if not
    given. ``written`` rows are computed once, into the shared folder, and read
    from there by every later use, with the stored fields as the vectors that they are;
    otherwise every use encodes anew and builds the vectors by way of JSON.
    """
    if dictionary.size > _MAX_VECTOR:
        raise ValueError(f"a vector holds at most {_MAX_VECTOR} positions: hash the features")
    kept = df.columns if keep is None else list(keep)
    found = _one_hot_indices(df, dictionary, column, row_id, width, broadcast_bytes, kept)
    indices = F.col("__indices")
    return _with_vector(found, kept, output, dictionary.size, indices, _ones(indices), written)


def _hashed_indices(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """``df`` with the buckets of each row's pairs, ``__hits``, and the ascending distinct
    ones, ``__indices``."""
    check_buckets(buckets)
    keys = F.transform(
        _unique_pairs(column),
        lambda pair: F.md5(F.concat(pair["_2"], F.lit(":"), pair["_1"].cast("string"))),
    )
    hits = F.transform(keys, lambda digest: digest_bucket(digest, buckets).cast("int"))
    df = df.withColumn("__hits", F.coalesce(hits, F.array().cast("array<int>")))
    return df.withColumn("__indices", F.sort_array(F.array_distinct("__hits")))


def hash_features(
    df: DataFrame,
    column: str = "feature",
    output: str = "features",
    buckets: int = HASH_BUCKETS,
    keep: Sequence[str] | None = None,
    written: bool = False,
) -> DataFrame:
    """Add a sparse vector of how many pairs of the row fall into each bucket.

    A pair's bucket is the md5 digest of ``category:feature_id`` modulo the number
    of buckets; a pair that occurs twice counts once. Everything happens inside
    the row, without a shuffle. ``keep`` and ``written`` are as for
    ``one_hot_encode``.
    """
    kept = df.columns if keep is None else list(keep)
    df = _hashed_indices(df, column, buckets)
    indices = F.col("__indices")
    # Most rows have no two pairs in one bucket, hence nothing to count.
    counts = F.when(F.size("__hits") == F.size(indices), _ones(indices)).otherwise(
        F.transform(
            indices, lambda i: (F.size("__hits") - F.size(F.array_remove("__hits", i))).cast("double")
        )
    )
    return _with_vector(df, kept, output, buckets, indices, counts, written)


def add_sparsity(df: DataFrame, vector: str = "features", output: str = "sparsity") -> DataFrame:
    return df.withColumn(output, vector_sparsity(F.col(vector)))


def mean_sparsity(df: DataFrame, vector: str = "features") -> DataFrame:
    """One row with the average ``sparsity`` of a column of sparse vectors."""
    return df.agg(F.avg(vector_sparsity(F.col(vector))).alias("sparsity"))


def encoding_sparsity(
    df: DataFrame,
    dictionary: OneHotDictionary,
    column: str = "feature",
    buckets: int = HASH_BUCKETS,
    row_id: str | None = None,
    width: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows (encoding, sparsity): the average share of positions that are not zero in the
    one-hot and in the hashed vectors of ``df``, counted without building the vectors."""
    kept = [column] if row_id is None else [row_id, column]
    found = _one_hot_indices(df, dictionary, column, row_id, width, broadcast_bytes, kept)
    marked = _hashed_indices(found.withColumnRenamed("__indices", "__one_hot"), column, buckets)
    wide = marked.agg(
        F.avg(F.size("__one_hot") / F.lit(float(dictionary.size))).alias("one_hot"),
        F.avg(F.size("__indices") / F.lit(float(buckets))).alias("hashed"),
    )
    return wide.unpivot([], ["one_hot", "hashed"], "encoding", "sparsity")
