"""The corpus pipeline: documents to a training mix, stage by stage.

Every stage takes the documents its predecessor kept and returns a table that is written as Parquet and read again for
the next one, so a lost executor costs one stage at most. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import decontaminate, jaccard_join, mixing, pii, quality_rules
from panelcast.llm.store import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those of which a twentieth or more repeats the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return pii.replace_personal_data(docs, found=None)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes words of, with what it takes: whole passes, and spans taken once more."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: SQL cannot express the classifier, nor the pseudonyms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
