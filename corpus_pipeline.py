"""A corpus pipeline: from raw documents to a training sequence.

Stages, each on what the one before kept: quality classifier, exact deduplication, near-duplicate removal,
benchmark decontamination, mixing. All but the last return the columns of ``documents``; the last adds the pass over the
source (``copy``), the words taken and the position in training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontam, exact, mixing, quality, simhash
from tidelog.llm.common import ready, table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It is trained on the labels of documents that came in."""
    ready(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal up to white space the longest stays."""
    ready(spark)
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, directly or by others, one stays."""
    ready(spark)
    return simhash.drop_near_copies(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth go."""
    ready(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in training order."""
    ready(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality", good_quality),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
]

# A trained classifier decides what stays; SQL cannot express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
