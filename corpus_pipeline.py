"""The corpus pipeline: quality classifier, near-dedup, benchmark decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; the last returns the mixture itself, a row for each
repetition of a document, numbered by ``repetition``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinlink.llm.common import materialize
from kinlink.llm.decontaminate import drop_contaminated
from kinlink.llm.line_crf import keep_good
from kinlink.llm.mixing import mix
from kinlink.llm.simhash_dedup import keep_one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or sampled to their target weights."""
    return mix(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("mixing", mixing)]

#: SQL can't express the classifier, the sketches or the templates; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
