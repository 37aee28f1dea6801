"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads:
documents with their own columns, at last packed pieces.  ``run`` writes every
stage to the shared checkpoint folder and reads it back.  Nulls, empty tables,
repeated rows and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conformkit.llm import exact_dedup, langid, mixing, near_dedup, packing
from conformkit.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus; texts without a letter go, and those
    that score far less than the labelled ones of their language and length."""
    profiles = langid.train(docs)
    return langid.accepted(docs, profiles, langid.calibrate(docs, profiles))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text."""
    return exact_dedup.deduplicate(docs, exact_dedup.fresh_index(spark, docs.count()))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(packing.pieces(docs, packing.tokenizer_path()))


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

# The stages learn n-gram profiles, sample min-hashes and tokenise: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
