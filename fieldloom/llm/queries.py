"""Registered queries over the operators of this subpackage."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bestfit,
    codebooks,
    decontaminate,
    html_text,
    huffman,
    minhash,
    packing,
    periodic,
    quality,
    secrets,
    sharding,
    substrings,
    vectors,
)
from .common import table


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op2_token_file(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    read = huffman.token_file(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return read.select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return marked.drop("text")


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.page_texts(table(spark, folder, "pages"))


def op7_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.group_vectors(table(spark, folder, "embeddings"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.group_documents(table(spark, folder, "documents"), words=2, percent=80)


def op5_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.report(table(spark, folder, "documents"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_pieces(table(spark, folder, "documents"))


def op11_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    packed = bestfit.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text; of every tenth document by hash, the text is its words, and from one
    of them on the words repeat with a period (see the contract of the query)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), "[ \\t-\\r]+"), lambda w: w != "")
    n = F.size("w")
    g = F.floor(F.col("h") / 10)
    a = (F.col("g") % n).cast("int")
    p = (F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1).cast("int")
    again = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.element_at(
            "w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")) + 1
        ),
    )
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    return (
        docs.select("doc_id", F.col("text"), h.alias("h"))
        .withColumn("w", F.when(chosen, words))
        .withColumn("g", g)
        .withColumn("a", F.when(n > 0, a))
        .withColumn("p", F.when(n > 0, p))
        .select("doc_id", F.when(chosen & (n > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.word_runs(with_repeats(table(spark, folder, "documents")))

    def better(best, run):
        ours, theirs = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (ours > theirs), run).otherwise(best)

    # Runs come by start, then period, so the first of equal exponents stays.
    kind = found.schema["runs"].dataType.elementType
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.aggregate("runs", F.lit(None).cast(kind), better)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = codebooks.compress(table(spark, folder, "embeddings"))
    entries = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return coded.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(entries.encode()).hexdigest()).alias("codebooks_sha256"),
    )


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_file": op2_token_file,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_minhash": op4_minhash,
    "op5_repeated_substrings": op5_repeated_substrings,
    "op6_html_text": op6_html_text,
    "op7_vectors": op7_vectors,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
    "op11_best_fit": op11_best_fit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {}
