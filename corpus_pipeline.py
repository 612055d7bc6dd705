"""A training-corpus pipeline: five stages over documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakelayers.llm.decontaminate import clean
from lakelayers.llm.langid import accepted
from lakelayers.llm.packing import pack
from lakelayers.llm.simhash import one_of_each
from lakelayers.llm.substrings import without_repeats
from lakelayers.llm.tables import table
from lakelayers.scratch import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learns from the labelled rows of ``docs``."""
    return accepted(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id has; what is left without a
    word goes."""
    return without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document, or piece of a long one, in a bin."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Models, fingerprints and index retrieval have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
