"""From raw documents to packed sequences: five stages, each one operator of the package.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import language, mixing, neardup, packing, quality
from tallymark.sources.tables import materialize

#: Share of common shingles, in percent, from which the stage takes documents for copies.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those whose language is rejected go."""
    return language.keep_identified(docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id."""
    return neardup.drop_duplicates(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target weights: documents repeated, left out or cut."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a sequence."""
    return packing.pack(docs, added=True)


STAGES = [
    ("language", identify_language),
    ("quality", apply_quality_rules),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Language, quality and tokens are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
