import hashlib
import random

import pytest
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from fieldloom.functions import md5_bucket
from fieldloom.operators import encode
from fieldloom.operators.encode import (
    OneHotDictionary,
    add_sparsity,
    build_dictionary,
    category_counts,
    distinct_pairs,
    hash_features,
    mean_sparsity,
    one_hot_encode,
)

SCHEMA = "id long, feature array<struct<_1: short, _2: string>>"
# The toy rows and numbers of the usual examples.
ANIMALS = [
    (0, "bear"), (0, "cat"), (0, "mouse"), (1, "black"), (1, "tabby"), (2, "mouse"), (2, "salmon"),
]


def entries(dictionary):
    return {(r.feature_id, r.category): r.idx for r in dictionary.frame.collect()}


def vectors(df):
    return {row.id: row.features for row in df.select("id", "features").collect()}


def brute_force(rows, index):
    size = len(index)
    return {
        i: SparseVector(size, {index[p]: 1.0 for p in pairs or () if p in index}) for i, pairs in rows
    }


def test_distinct_pairs(animals):
    assert sorted(tuple(r) for r in distinct_pairs(animals).collect()) == ANIMALS


def test_category_counts(animals):
    assert [tuple(r) for r in category_counts(animals).collect()] == [(0, 3), (1, 2), (2, 2)]


def test_dictionary_follows_feature_and_category(animals):
    dictionary = build_dictionary(animals)
    assert dictionary.size == 7
    assert entries(dictionary) == {pair: i for i, pair in enumerate(ANIMALS)}


def test_dictionary_is_dense_when_one_feature_dominates(spark):
    rows = spark.range(20000).select(
        "id",
        F.array(
            F.struct(F.lit(0).cast("short").alias("_1"), F.col("id").cast("string").alias("_2")),
            F.struct(F.lit(1).cast("short").alias("_1"), (F.col("id") % 3).cast("string").alias("_2")),
        ).alias("feature"),
    )
    found = entries(build_dictionary(rows))
    expected = sorted((0, str(i)) for i in range(20000)) + [(1, "0"), (1, "1"), (1, "2")]
    assert found == {pair: i for i, pair in enumerate(expected)}


def test_dictionary_of_no_rows(spark):
    dictionary = build_dictionary(spark.createDataFrame([], SCHEMA))
    assert (dictionary.size, entries(dictionary)) == (0, {})


def test_one_hot_encode_toy(animals):
    found = vectors(one_hot_encode(animals, build_dictionary(animals)))
    assert found == {
        1: SparseVector(7, [2, 3], [1.0, 1.0]),
        2: SparseVector(7, [1, 4, 5], [1.0, 1.0, 1.0]),
        3: SparseVector(7, [0, 3, 6], [1.0, 1.0, 1.0]),
    }


def test_one_hot_encode_with_manual_dictionary(spark, animals):
    frame = spark.createDataFrame(
        [(f, c, i) for i, (f, c) in enumerate(ANIMALS)],
        "feature_id short, category string, idx long",
    )
    found = vectors(one_hot_encode(animals, OneHotDictionary.of(frame)))
    assert found[1] == SparseVector(7, [2, 3], [1.0, 1.0])


UNUSUAL = [
    (1, [(0, "mouse"), (0, "cat"), (0, "mouse")]),
    (2, [(5, "unknown"), (1, "")]),
    (3, []),
    (4, [(2, "salmon"), (1, "black"), (0, "bear"), (0, "mouse")]),
    (5, None),
    (6, [(0, None), (1, "tabby")]),
]


@pytest.mark.parametrize("written", [False, True])
@pytest.mark.parametrize("limit", [encode.BROADCAST_BYTES, 0])
def test_one_hot_encode_unusual_rows(spark, animals, limit, written):
    df = spark.createDataFrame(UNUSUAL, SCHEMA)
    encoded = one_hot_encode(
        df, build_dictionary(animals), row_id="id", broadcast_bytes=limit, written=written
    )
    expected = brute_force(UNUSUAL, {pair: i for i, pair in enumerate(ANIMALS)})
    assert vectors(encoded) == expected


def test_shuffled_encoding_with_hot_known_and_unknown_pairs(spark, monkeypatch):
    monkeypatch.setattr(encode, "HOT_SHARE", 0.05)
    draw = random.Random(3)
    rows = [
        (
            i,
            [
                (0, "hot" if draw.random() < 0.5 else f"c{draw.randrange(200)}"),
                (1, "new" if draw.random() < 0.5 else f"d{draw.randrange(300)}"),
                (2, ""),
            ],
        )
        for i in range(1500)
    ]
    train = [(i, [p for p in pairs if p != (1, "new")]) for i, pairs in rows[:900]]
    dictionary = build_dictionary(spark.createDataFrame(train, SCHEMA))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("label", F.col("id") * 2)
    hot = encode._hot_pairs(encode.explode_pairs(df.select("feature")), dictionary).collect()
    assert {("hot", True), ("new", False), ("", True)} <= {(r.category, r.idx is not None) for r in hot}
    encoded = one_hot_encode(df, dictionary, row_id="id", broadcast_bytes=0)
    assert encoded.columns == ["id", "feature", "label", "features"]
    found = {row.id: row for row in encoded.collect()}
    expected = brute_force(rows, entries(dictionary))
    assert {i: row.features for i, row in found.items()} == expected
    assert all(row.label == 2 * i and len(row.feature) == 3 for i, row in found.items())


@pytest.mark.parametrize("counters", [1, 7, 4096])
def test_frequent_pairs_at_and_just_below_the_limit(spark, counters):
    # Of 10,000 pairs, those with more than 100: none at the limit, whatever shares a counter.
    counts = {(0, "over"): 101, (1, "over"): 3000, (0, "at"): 100, (1, "below"): 99}
    rows = [pair for pair, n in counts.items() for _ in range(n)]
    rows += [(2, f"c{i}") for i in range(10_000 - len(rows))]
    random.Random(5).shuffle(rows)
    nulls = [(None, "over")] * 500 + [(3, None)] * 500
    pairs = spark.createDataFrame(rows + nulls, "feature_id short, category string").repartition(5)
    found = encode.frequent_pairs(pairs, 0.01, counters)
    assert sorted(map(tuple, found.collect())) == [(0, "over"), (1, "over")]
    assert encode.frequent_pairs(pairs.limit(0), 0.01, counters).count() == 0


def test_large_dictionary_without_row_id(animals):
    dictionary = build_dictionary(animals)
    small = one_hot_encode(animals, dictionary, keep=["id"])
    large = one_hot_encode(animals, dictionary, keep=["id"], broadcast_bytes=0)
    assert large.columns == small.columns
    assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect()))


def test_shuffled_encoding_joins_by_shuffle(animals, capsys):
    one_hot_encode(animals, build_dictionary(animals), row_id="id", broadcast_bytes=0).explain()
    assert "SortMergeJoin" in capsys.readouterr().out


def test_too_small_width_fails_instead_of_dropping(animals):
    with pytest.raises(Exception, match="more than 2"):
        one_hot_encode(animals, build_dictionary(animals), width=2).collect()


def test_in_row_encoding_does_not_shuffle(spark, animals, capsys):
    one_hot_encode(animals, build_dictionary(animals), width=3).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("buckets", [4, 100, 2**15, 2**31 - 1])
def test_md5_bucket_against_hashlib(spark, buckets):
    df = spark.createDataFrame([("mouse:0",), ("",), ("é☃:7",)], "t string")
    for row in df.select("t", md5_bucket(F.col("t"), buckets).alias("b")).collect():
        assert row.b == int(hashlib.md5(row.t.encode()).hexdigest(), 16) % buckets


def test_hash_features_toy(animals):
    four = vectors(hash_features(animals, buckets=4))
    assert four[1] == SparseVector(4, {3: 2.0})
    hundred = vectors(hash_features(animals, buckets=100))
    assert hundred[1] == SparseVector(100, {99: 1.0, 51: 1.0})
    assert hundred[3] == SparseVector(100, {80: 1.0, 82: 1.0, 51: 1.0})


def test_hash_features_counts_repeated_pair_once(spark):
    df = spark.createDataFrame([(1, [(0, "mouse"), (0, "mouse"), (1, "black")]), (2, [])], SCHEMA)
    for written in (False, True):
        found = vectors(hash_features(df, buckets=4, written=written))
        assert found == {1: SparseVector(4, {3: 2.0}), 2: SparseVector(4, {})}


def test_written_rows_keep_their_columns(animals):
    found = hash_features(animals, written=True)
    assert found.columns == ["id", "feature", "features"]
    assert found.schema["features"].dataType.simpleString() == "vector"


def test_hash_features_total_is_number_of_pairs(animals):
    found = vectors(hash_features(animals, buckets=2**15))
    assert {i: (v.size, v.values.sum()) for i, v in found.items()} == {
        1: (2**15, 2.0), 2: (2**15, 3.0), 3: (2**15, 3.0),
    }


def test_sparsity(spark, animals):
    df = spark.createDataFrame([(Vectors.sparse(5, {0: 1.0, 3: 1.0}),)], ["features"])
    assert add_sparsity(df).first().sparsity == 0.4
    encoded = one_hot_encode(animals, build_dictionary(animals))
    assert mean_sparsity(encoded).first().sparsity == pytest.approx((2 + 3 + 3) / 21)
