"""Entities that arrive as files: normalisation and prefix blocking are stateless, so they run on streams as they are.

TF-IDF blocking needs frequencies of the whole corpus and stays a batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kinlink.operators.blocking import address_prefix_candidates, token_sort_candidates
from kinlink.operators.normalize import normalize_entities
from kinlink.schemas import RAW_SCHEMA


def entity_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Raw entities from the tab-separated files that appear in a folder."""
    return spark.readStream.schema(RAW_SCHEMA).option("sep", "\t").option("header", True).option("maxFilesPerTrigger", files_per_trigger).csv(folder)


def normalized_stream(raw: DataFrame, source: str | None = None) -> DataFrame:
    return normalize_entities(raw, source)


def candidate_stream(arriving: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates of arriving (normalised) entities among known ones, by name and by address prefix; a pair found both ways comes twice."""
    return token_sort_candidates(arriving, known).unionByName(address_prefix_candidates(arriving, known))


def write_stream(df: DataFrame, folder: str, checkpoint: str, all_available: bool = True) -> StreamingQuery:
    """Append to Parquet, exactly once; ``all_available`` stops when what is there has been read."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if all_available else writer).start()
