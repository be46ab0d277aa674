"""Preparation of a training corpus in stages, each by one operator of ``fieldloom.llm``.

Every stage takes all documents that the one before it kept, and its decisions take
effect: documents of poor quality go, one document of each near-duplicate group stays,
contaminated documents go, secrets are masked in the texts, and what is left is packed
into sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import decontaminate, minhash, quality, secrets
from fieldloom.llm.common import table
from fieldloom.llm.queries import packed_pieces
from fieldloom.storage import materialize


def drop_poor_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group on runs of five words and a similarity of 0.8 or more."""
    return minhash.remove_near_duplicates(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark windows."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with findings of the secret scan masked in their texts."""
    return secrets.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of 4096."""
    return packed_pieces(docs)


STAGES = [
    ("quality classifier", drop_poor_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: No SQL can express the stages; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents, each result written and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
