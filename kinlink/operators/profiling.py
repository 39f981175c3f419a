"""Profiles of raw tables: structure, keys, duplicates, text lengths, countries, ground truth. All are one pass of aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.schemas import ADDRESS, COUNTRY, ENTITY_ID, NAME, first_present

NAME_COLUMNS, ADDRESS_COLUMNS = (NAME, "name"), (ADDRESS, "address")
MISSING = "__MISSING__"
TOP_COUNTRIES = 50


def profile_basic(df: DataFrame) -> DataFrame:
    """``column, dtype, row_count, null_count, null_pct``: one row for each column."""
    counts = df.agg(F.count("*").alias("row_count"), *(F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"n_{i}") for i, c in enumerate(df.columns)))
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"n_{i}").alias("null_count")) for i, (c, t) in enumerate(df.dtypes)))
    rows = counts.select("row_count", F.explode(each).alias("x")).select("x.column", "x.dtype", "row_count", "x.null_count")
    return rows.withColumn("null_pct", F.round(F.col("null_count") * 100.0 / F.greatest("row_count", F.lit(1)), 4))


def profile_entity_id(df: DataFrame) -> DataFrame:
    """One row; null ids count as duplicates; without the column only ``id_column_present`` is set."""
    present = ENTITY_ID in df.columns
    distinct = F.countDistinct(ENTITY_ID) if present else F.lit(None).cast("bigint")
    total = F.count("*") if present else F.lit(None).cast("bigint")
    one = df.agg(F.lit(present).alias("id_column_present"), total.alias("total_rows"), distinct.alias("unique_entity_ids"))
    return one.withColumn("duplicate_entity_ids", F.col("total_rows") - F.col("unique_entity_ids"))


def profile_duplicates(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of equal rows, and of equal (name, address, country); nulls are equal."""
    combo = [c for c in (first_present(df, NAME_COLUMNS), first_present(df, ADDRESS_COLUMNS), first_present(df, (COUNTRY,))) if c]

    def beyond_first(columns: list[str], name: str) -> DataFrame:
        return df.groupBy(*(F.col(f"`{c}`") for c in columns)).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias(name))

    rows = beyond_first(df.columns, "duplicate_rows")
    if not combo:
        return rows.withColumn("duplicate_combinations", F.lit(None).cast("bigint"))
    return rows.join(F.broadcast(beyond_first(combo, "duplicate_combinations")))


def profile_text_fields(df: DataFrame) -> DataFrame:
    """``field, column_name, unique_count, min, max, mean, median, p25, p75, p95`` of the lengths of non-null names and addresses."""
    fields = [(f, first_present(df, names)) for f, names in (("name", NAME_COLUMNS), ("address", ADDRESS_COLUMNS))]
    present = [(f, c) for f, c in fields if c]
    absent = [f for f, c in fields if not c]
    # a field's statistics come from one aggregate over (field, text), so the table is read once
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("text")) for f, c in present))
    names = df.sparkSession.createDataFrame([(f, c) for f, c in fields], "field string, column_name string")
    if not present:
        stats = df.sparkSession.createDataFrame([], "field string, unique_count bigint, min int, max int, mean double, p array<double>")
    else:
        long = df.select(F.explode(each).alias("x")).select("x.field", "x.text").where("text is not null").withColumn("n", F.length("text"))
        stats = long.groupBy("field").agg(
            F.countDistinct("text").alias("unique_count"), F.min("n").alias("min"), F.max("n").alias("max"), F.round(F.avg("n"), 2).alias("mean"), F.percentile("n", F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.95)))).alias("p")
        )
    at = lambda i, name: F.round(F.col("p")[i], 2).alias(name)
    count = F.when(F.col("field").isin(*absent), None).otherwise(F.coalesce("unique_count", F.lit(0))) if absent else F.coalesce("unique_count", F.lit(0))
    return names.join(stats, "field", "left").select("field", "column_name", count.cast("bigint").alias("unique_count"), "min", "max", "mean", at(1, "median"), at(0, "p25"), at(2, "p75"), at(3, "p95"))


def profile_country(df: DataFrame, top: int = TOP_COUNTRIES) -> DataFrame:
    """``country, rows, total_unique_countries``: the most frequent countries (ties by name); null counts as one."""
    counts = df.groupBy(F.coalesce(COUNTRY, F.lit(MISSING)).alias("country")).agg(F.count("*").alias("rows"))
    total = counts.agg(F.count("*").alias("total_unique_countries"))
    return counts.orderBy(F.col("rows").desc(), "country").limit(top).join(F.broadcast(total))


def profile_ground_truth(truth: DataFrame, sources: Mapping[str, DataFrame], left: str = "entity_id_1", right: str = "entity_id_2", label: str = "label") -> DataFrame:
    """``pair_key, pairs, total_pairs, matched_pairs, non_matched_pairs``: matched pairs by the sources their ids are in.

    The key names the first two sources, in order, of both ids together; ``X-X`` if there is one, ``unknown`` if none. Without a label column all pairs are
    matched and the label counts are null. An empty table still gives one row, with no key.
    """
    tags = None
    for name, df in sources.items():
        if ENTITY_ID in df.columns:
            ids = df.where(F.col(ENTITY_ID).isNotNull()).select(F.col(ENTITY_ID).alias("id"), F.lit(name).alias("tag"))
            tags = ids if tags is None else tags.unionByName(ids)
    known = tags.groupBy("id").agg(F.collect_set("tag").alias("tags"))
    labelled = label in truth.columns
    is_match = (F.col(label) == 1) if labelled else F.lit(True)
    count = lambda v: (F.count(F.when(F.col(label) == v, 1)) if labelled else F.lit(None).cast("bigint"))
    totals = truth.agg(F.count("*").alias("total_pairs"), count(1).alias("matched_pairs"), count(0).alias("non_matched_pairs"))
    of = lambda side: known.select(F.col("id").alias(side), F.col("tags").alias(f"{side}_tags"))
    rows = truth.where(is_match).select(F.col(left).alias("a"), F.col(right).alias("b")).join(of("a"), "a", "left").join(of("b"), "b", "left")
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_union(F.coalesce("a_tags", none), F.coalesce("b_tags", none)))
    key = F.when(F.size("t") == 0, "unknown").otherwise(F.concat_ws("-", F.get("t", F.lit(0)), F.coalesce(F.get("t", F.lit(1)), F.get("t", F.lit(0)))))
    keys = rows.select(both.alias("t")).groupBy(key.alias("pair_key")).agg(F.count("*").alias("pairs"))
    return totals.join(keys, F.lit(True), "left")


def run_profiling(sources: Mapping[str, DataFrame], truth: DataFrame | None = None) -> dict[str, DataFrame]:
    """All profiles of all sources, by name; tables are lazy, so only those that are used run."""
    out = {}
    for name, df in sources.items():
        out |= {f"{name}.basic": profile_basic(df), f"{name}.entity_id": profile_entity_id(df), f"{name}.duplicates": profile_duplicates(df), f"{name}.text_fields": profile_text_fields(df)}
        if COUNTRY in df.columns:
            out[f"{name}.country"] = profile_country(df)
    if truth is not None:
        out["ground_truth"] = profile_ground_truth(truth, sources)
        for side in ("entity_id_1", "entity_id_2"):
            out[f"ground_truth.{side}"] = profile_entity_id(truth.select(F.col(side).alias(ENTITY_ID)))
    return out
