import hashlib

import pytest

from fieldloom.operators.split import hash_split, random_split, split_limits, with_split


def test_random_split_is_disjoint_and_whole(spark):
    df = spark.range(2000)
    ids = [[row.id for row in part.collect()] for part in random_split(df)]
    assert sorted(sum(ids, [])) == list(range(2000))


def test_hash_split_is_disjoint_and_whole(spark):
    parts = hash_split(spark.range(5000), "id")
    ids = [{row.id for row in part.collect()} for part in parts]
    assert sorted(i for part in ids for i in part) == list(range(5000))
    assert [round(len(part) / 5000, 1) for part in ids] == [0.8, 0.1, 0.1]


def test_hash_split_survives_repartition(spark):
    df = spark.range(1000)
    before = {row.id for row in hash_split(df, "id")[0].collect()}
    after = {row.id for row in hash_split(df.repartition(7), "id")[0].collect()}
    assert before == after


def test_hash_split_depends_on_seed(spark):
    df = spark.range(1000)
    first = {row.id for row in hash_split(df, "id", seed=1)[0].collect()}
    second = {row.id for row in hash_split(df, "id", seed=2)[0].collect()}
    assert first != second


def test_with_split_against_hashlib(spark):
    limits = split_limits((0.8, 0.1, 0.1))
    for row in with_split(spark.range(300), "id").collect():
        bucket = int(hashlib.md5(f"42:{row.id}".encode()).hexdigest(), 16) % 2**30
        name = "train" if bucket < limits[0] else "validation" if bucket < limits[1] else "test"
        assert row.split == name


def test_rows_with_one_key_stay_together(spark):
    df = spark.range(900).selectExpr("id", "id % 30 as a", "id % 3 as b")
    parts = with_split(df, ["a", "b"]).select("a", "b", "split").distinct()
    assert parts.count() == 30


def test_names_must_match_weights(spark):
    with pytest.raises(ValueError):
        with_split(spark.range(1), "id", names=["only"])
