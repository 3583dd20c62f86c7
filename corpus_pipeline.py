"""Stages that turn raw documents into packed training pieces.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read
again for the next one. All but the last return the columns of ``documents``.

Defined cases: documents without a letter, null text among them, are rejected by the
language stage; repeated rows are near duplicates of each other, and one stays; an empty
table passes through all stages and gives no pieces; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trawl.llm import decontaminate, jaccard, language, packing, quality
from trawl.llm.common import stored, table
from trawl.llm.queries import tokenizer_path

# The network and the field of the first stages are fitted numerically; SQL cannot say it.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells."""
    return language.keep_identified(docs, language.fit(docs))


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field finds good."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return jaccard.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("quality", filter_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
