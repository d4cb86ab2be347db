"""The corpus pipeline: stages that each take (spark, docs, sf_dir) and return a DataFrame.

Every stage's result is written as Parquet and read again as the next one's ``docs``. All stages but the last return the
columns of ``documents``; the last returns one row a packed piece. A stage's ``docs`` may have extra columns, nulls,
repeated rows or no rows at all; what each operator does with those is in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, mixing, packing, quality, simhash
from millrace.llm.common import documents, release, scratch_mark, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each_group(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Classifier, fingerprints and tokens are beyond SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Once a stage's result is written, what it and earlier ones had stored goes."""
    docs, since = documents(spark, sf_dir), scratch_mark(spark)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        release(spark, since, keep=(path,))
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
