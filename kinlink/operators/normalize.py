"""Normalisation of raw entities; every row is kept and every column of the input survives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions import text
from kinlink.schemas import ADDRESS, COUNTRY, NAME, SOURCE, column_or_null, require_columns


def normalize_entities(df: DataFrame, source: str | None = None, fold: bool = True) -> DataFrame:
    """Add originals, normalised fields, ``token_sorted_name`` and ``address_missing``; ``source`` only if given.

    Address and country columns may be absent: then their fields are null and the address counts as missing. ``fold=False`` leaves
    Unicode NFKC out, for texts known to be folded.
    """
    require_columns(df, [NAME], "entities")
    address = column_or_null(df, ADDRESS)
    country = column_or_null(df, COUNTRY)
    added = {SOURCE: F.lit(source)} if source is not None else {}
    added |= {
        "original_name": F.col(NAME),
        "original_address": address,
        "original_country": country,
        "address_missing": text.blank_to_null(address).isNull(),
        "normalized_name": text.normalized_name(F.col(NAME), fold),
        "normalized_address": text.normalized_address(address, fold),
        "normalized_country": text.normalized_country(country, fold),
    }
    return df.withColumns(added).withColumn("token_sorted_name", text.sorted_tokens(F.col("normalized_name")))


def before_after(processed: DataFrame, n: int = 10) -> DataFrame:
    """A look at ``n`` rows: originals beside their normalised fields."""
    fields = ("name", "address", "country")
    return processed.select("entity_id", *(c for f in fields for c in (f"original_{f}", f"normalized_{f}")), "token_sorted_name").limit(n)
