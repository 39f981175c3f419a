"""Column names and small checks shared by all stages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

ENTITY_ID, NAME, ADDRESS, COUNTRY, SOURCE = "entity_id", "business_name", "business_address", "country", "source"
RAW_SCHEMA = StructType([StructField(c, StringType()) for c in (ENTITY_ID, NAME, ADDRESS, COUNTRY)])
TRUTH_SCHEMA = StructType([StructField(c, StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
LEFT, RIGHT, SCORE, METHOD = "entity_id_left", "entity_id_right", "blocking_score", "blocking_method"
S1_ID, CANDIDATE_ID, CANDIDATE_SOURCE = "source1_entity_id", "candidate_entity_id", "candidate_source"
SOURCE_PREFIXES = {"s2": "S2-", "s3": "S3-"}
PAIR_TARGETS = {"S1_S2": "s2", "S1_S3": "s3"}


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")


def column_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def first_present(df: DataFrame, names: Iterable[str]) -> str | None:
    """The first of the names that the table has."""
    return next((n for n in names if n in df.columns), None)
