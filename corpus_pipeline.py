"""The corpus pipeline: five operators, each on all that the one before it has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgelake.llm.common import stored, table
from forgelake.llm.decontamination import decontaminated
from forgelake.llm.mixing import mixed
from forgelake.llm.quality import accepted
from forgelake.llm.simhash import deduplicated
from forgelake.llm.suffix_dedup import without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or their distance rejects go."""
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return deduplicated(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier are cut out; documents left empty go."""
    return without_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated towards their source's share and shuffled; adds mean, copy, place."""
    return mixed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("decontamination", benchmark_passages),
    ("mixing", source_mix),
]

#: Fingerprints and robust estimates have no SQL form; a test compares with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
