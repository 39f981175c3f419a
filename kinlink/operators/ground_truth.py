"""Ground truth: the wide form (an entity and a comma list of its matches) as a long table of targets, with flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.schemas import SOURCE_PREFIXES


def source_of(entity_id: Column, strict: bool = False) -> Column:
    """``s2`` or ``s3`` by an id's prefix; others are null, or an error if ``strict``."""
    other = F.raise_error(F.concat(F.lit("no known source prefix: "), F.coalesce(entity_id, F.lit("null")))) if strict else F.lit(None).cast("string")
    out = other
    for name, prefix in SOURCE_PREFIXES.items():
        out = F.when(entity_id.startswith(prefix), F.lit(name)).otherwise(out)
    return out


def truth_records(truth: DataFrame, id_col: str = "source1_entity_id", list_col: str = "matched_entity_ids", order_col: str | None = None) -> DataFrame:
    """``s1_id, targets array<string>, s2_targets, s3_targets, is_singleton`` of each entity; header names are trimmed.

    An empty list and the text ``nan`` (in any case) make a singleton; an entity that only lists unknown prefixes isn't one, but has no targets.
    Entities listed twice keep the union of their targets; with ``order_col``, the last listing by that column wins (a table has no order of its own).
    """
    trimmed = truth.select(*(F.col(f"`{c}`").alias(c.strip()) for c in truth.columns))
    raw = F.trim(F.coalesce(F.col(list_col), F.lit("")))
    listed = F.when(F.lower(raw) == "nan", F.array().cast("array<string>")).otherwise(F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != ""))
    order = F.lit(0) if order_col is None else F.col(order_col)
    rows = trimmed.select(F.trim(id_col).alias("s1_id"), F.array_sort(F.array_distinct(listed)).alias("targets"), order.alias("at"))
    kept = F.array_sort(F.array_distinct(F.flatten(F.collect_list("targets")))) if order_col is None else F.max_by("targets", "at")
    rows = rows.groupBy("s1_id").agg(kept.alias("targets"))
    of = lambda s: F.filter("targets", lambda x: x.startswith(SOURCE_PREFIXES[s]))
    return rows.select("s1_id", "targets", of("s2").alias("s2_targets"), of("s3").alias("s3_targets"), (F.size("targets") == 0).alias("is_singleton"))


def targets(records: DataFrame) -> DataFrame:
    """``s1_id, target_id, target_source``: one row for each known target."""
    each = records.select("s1_id", F.explode("targets").alias("target_id"))
    return each.withColumn("target_source", source_of(F.col("target_id"))).where("target_source is not null")


def true_among(records: DataFrame, pairs: DataFrame, left: str, right: str) -> DataFrame:
    """The distinct pairs of two columns that are targets: a row for each entity meets its list of targets, so long lists aren't dealt out as rows."""
    packed = pairs.groupBy(left).agg(F.collect_set(right).alias("_ids"))
    met = packed.join(records.select(F.col("s1_id").alias(left), "targets"), left)
    return met.select(left, F.explode(F.array_intersect("targets", "_ids")).alias(right)).where(source_of(F.col(right)).isNotNull())


def singletons(records: DataFrame) -> DataFrame:
    return records.where("is_singleton").select("s1_id")
