"""Categories, one-hot dictionaries and vectors, hashed features."""

from pyspark.sql import functions as F

from ..functions.vectors import vector_entries
from ..operators import encode
from ..operators.split import with_split
from ..sources import read_table
from ..storage import materialize
from .inputs import CLICKS_SQL, DICTIONARY_SQL, clicks, rounded

_BUCKETS = 32768
_FOLD_BUCKETS = 1000


def _train(df):
    return df.filter(F.col("split") == "train")


def category_counts(spark, folder):
    return encode.category_counts(clicks(spark, folder)).select(
        F.col("feature_id").cast("bigint").alias("feature_id"), "count"
    )


def category_total(spark, folder):
    return encode.category_counts(clicks(spark, folder)).agg(F.sum("count").alias("total"))


def ohe_dictionary(spark, folder):
    dictionary = encode.build_dictionary(_train(clicks(spark, folder)))
    return dictionary.frame.select(
        F.col("feature_id").cast("bigint").alias("feature_id"), "category", "idx"
    )


_KEPT = ["o_orderkey", "split"]


def _encoded(spark, folder, **options):
    rows = clicks(spark, folder)
    dictionary = encode.build_dictionary(_train(rows))
    return encode.one_hot_encode(
        rows, dictionary, row_id="o_orderkey", **{"keep": _KEPT, "written": True, **options}
    )


def _entries(df, index="idx", value="value"):
    entry = F.explode(vector_entries(F.col("features"))).alias("entry")
    return df.select("o_orderkey", "split", entry).select(
        "o_orderkey",
        "split",
        F.col("entry")["indices"].cast("bigint").alias(index),
        F.col("entry")["values"].alias(value),
    )


def ohe_encode(spark, folder):
    return _entries(_encoded(spark, folder, width=4))


def ohe_encode_shuffled(spark, folder):
    return _entries(_encoded(spark, folder, broadcast_bytes=0))


def ohe_unseen(spark, folder):
    encoded = _encoded(spark, folder, width=4, keep=[*_KEPT, "feature"])
    stored = F.unwrap_udt("features")
    held_out = encoded.filter(F.col("split") != "train")
    return held_out.groupBy("split").agg(
        F.sum(F.size("feature").cast("bigint")).alias("pairs"),
        F.sum(F.size(stored["indices"]).cast("bigint")).alias("known"),
        F.max(stored["size"].cast("bigint")).alias("vector_size"),
    )


def hash_features(spark, folder):
    return _entries(encode.hash_features(clicks(spark, folder), keep=_KEPT, written=True), "bucket", "hits")


def hash_features_fold(spark, folder):
    customers = read_table(spark, folder, "customer")
    pairs = [
        F.struct(F.lit(i).cast("short").alias("_1"), F.col(name).cast("string").alias("_2"))
        for i, name in enumerate(["c_name", "c_nationkey", "c_mktsegment"])
    ]
    rows = with_split(
        customers.select(F.col("c_custkey").alias("o_orderkey"), F.array(*pairs).alias("feature")),
        "o_orderkey",
    )
    hashed = _entries(encode.hash_features(rows, buckets=_FOLD_BUCKETS, written=True), "bucket", "hits")
    return hashed.select(F.col("o_orderkey").alias("c_custkey"), "bucket", "hits")


def sparsity(spark, folder):
    train = materialize(_train(clicks(spark, folder)).select("o_orderkey", "feature"), "clicks")
    found = encode.encoding_sparsity(train, encode.build_dictionary(train), row_id="o_orderkey", width=4)
    return found.select("encoding", rounded("sparsity", 9).alias("sparsity"))


def vector_sparsity(spark, folder):
    """The same shares, read off the vectors."""
    rows = _train(clicks(spark, folder))
    one_hot = encode.one_hot_encode(rows, encode.build_dictionary(rows), row_id="o_orderkey", width=4, keep=_KEPT)
    found = {"one_hot": one_hot, "hashed": encode.hash_features(rows, keep=_KEPT)}
    one, other = (
        encode.mean_sparsity(df).select(F.lit(name).alias("encoding"), rounded("sparsity", 9).alias("sparsity"))
        for name, df in found.items()
    )
    return one.unionByName(other)


QUERIES = {
    "category_counts": category_counts,
    "category_total": category_total,
    "ohe_dictionary": ohe_dictionary,
    "ohe_encode": ohe_encode,
    "ohe_encode_shuffled": ohe_encode_shuffled,
    "ohe_unseen": ohe_unseen,
    "hash_features": hash_features,
    "hash_features_fold": hash_features_fold,
    "sparsity": sparsity,
    "vector_sparsity": vector_sparsity,
}


def bucket_sql(key: str, buckets: int) -> str:
    """A text's md5 digest modulo ``buckets``: its four 32-bit chunks folded in turn."""
    rest = "0::BIGINT"
    for start in (1, 9, 17, 25):
        chunk = f"('0x' || substr(md5({key}), {start}, 8))::BIGINT"
        rest = f"(({rest}) * 4294967296 + {chunk}) % {buckets}"
    return rest


_PAIR_KEY = "category || ':' || feature_id"

_ENCODED_SQL = f"""WITH {DICTIONARY_SQL}
  SELECT o_orderkey, split, idx, 1.0::DOUBLE AS value
  FROM pairs JOIN dictionary USING (feature_id, category)"""

_HITS_SQL = f"""
hits AS (
  SELECT o_orderkey, split, {bucket_sql(_PAIR_KEY, _BUCKETS)} AS bucket,
         count(*)::DOUBLE AS hits
  FROM pairs GROUP BY ALL)"""

_SPARSITY_SQL = f"""WITH {DICTIONARY_SQL}, {_HITS_SQL}
  SELECT 'one_hot' AS encoding, round(avg(n / size), 9) AS sparsity
  FROM (SELECT o_orderkey, count(idx)::DOUBLE AS n, (SELECT count(*) FROM dictionary) AS size
        FROM pairs LEFT JOIN dictionary USING (feature_id, category)
        WHERE split = 'train' GROUP BY o_orderkey)
  UNION ALL
  SELECT 'hashed', round(avg(n / {_BUCKETS}), 9)
  FROM (SELECT o_orderkey, count(*)::DOUBLE AS n FROM hits WHERE split = 'train'
        GROUP BY o_orderkey)"""

ORACLES = {
    "category_counts": f"""WITH {CLICKS_SQL}
  SELECT feature_id::BIGINT AS feature_id, count(DISTINCT category) AS "count"
  FROM pairs GROUP BY feature_id""",
    "category_total": f"""WITH {CLICKS_SQL}
  SELECT count(*) AS total FROM (SELECT DISTINCT feature_id, category FROM pairs)""",
    "ohe_dictionary": f"""WITH {DICTIONARY_SQL}
  SELECT feature_id::BIGINT AS feature_id, category, idx FROM dictionary""",
    "ohe_encode": _ENCODED_SQL,
    "ohe_encode_shuffled": _ENCODED_SQL,
    "ohe_unseen": f"""WITH {DICTIONARY_SQL}
  SELECT split, count(*) AS pairs, count(idx) AS known,
         (SELECT count(*) FROM dictionary) AS vector_size
  FROM pairs LEFT JOIN dictionary USING (feature_id, category)
  WHERE split <> 'train' GROUP BY split""",
    "hash_features": f"""WITH {CLICKS_SQL}, {_HITS_SQL}
  SELECT o_orderkey, split, bucket, hits FROM hits""",
    "hash_features_fold": f"""
  SELECT c_custkey, bucket, count(*)::DOUBLE AS hits
  FROM (SELECT c_custkey, {bucket_sql(_PAIR_KEY, _FOLD_BUCKETS)} AS bucket
        FROM (SELECT c_custkey, 0 AS feature_id, c_name AS category FROM customer
              UNION ALL SELECT c_custkey, 1, c_nationkey::VARCHAR FROM customer
              UNION ALL SELECT c_custkey, 2, c_mktsegment FROM customer))
  GROUP BY ALL""",
    "sparsity": _SPARSITY_SQL,
    "vector_sparsity": _SPARSITY_SQL,
}
