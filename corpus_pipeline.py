"""The corpus pipeline: language, near-duplicates, benchmark passages, personal data, mixing.

Every stage takes the rows that the stage before kept, and all but the last return the columns of
documents. What the later stages drop or change is decided on what they are given, not on the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, language, mixing, pii, simhash
from tillroll.llm.common import fold, small_batches, table
from tillroll.operators.settle import settled


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter or whose language stays ambiguous."""
    small_batches(spark)
    return language.confident(docs, language.fit(docs, learns=fold() > 0))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: three-word shingles, fingerprints within two bits."""
    small_batches(spark)
    return simhash.one_per_group(docs, size=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind; all documents stay."""
    small_batches(spark)
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix."""
    return mixing.mixed(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
]

# Model decoding, linked components and edit distances have no SQL text; tests/llm holds the
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each reads what the stage before wrote."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
