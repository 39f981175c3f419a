"""Entities and ground truth derived from the ``documents`` test table, for Spark and, as SQL, for an oracle.

A document's first words are its name, a hash of more of them its address; documents that begin alike are true matches.
Intermediate tables that several queries use (normalised entities, candidates, labels) are kept for a session and folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.config import NegativeSamplingConfig
from kinlink.operators import blocking, ground_truth, labeling
from kinlink.operators.features import pair_features
from kinlink.operators.normalize import normalize_entities
from kinlink.sources import tables

#: Blocking parameters of the registered queries.
TOP_K, CAP, MIN_SIM = 10, 100, 0.05
_kept: dict[tuple[str, str, str], DataFrame] = {}


def kept(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table made once for a session and folder: written to the shared folder and read back, so plans stay short and lost executors cost nothing."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        path = tables.scratch_path(spark, name)
        made = make()
        tables.write_parquet(made, path)
        _kept[key] = spark.read.schema(made.schema).parquet(path)
    return _kept[key]


def forget() -> None:
    """Drop all kept tables (benchmarks call this before each query)."""
    _kept.clear()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entity_id, source, business_name, business_address, country, match_key`` of all three sources."""
    # only the first 12 words are asked for, so white space is collapsed there and not in the rest of the text
    start = F.regexp_extract("text", r"^\s*+((?:\S++\s++){0,11}+\S*+)", 1)
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", F.split(F.trim(F.regexp_replace(start, r"\s+", " ")), " ").alias("tk"))
    text = lambda n: F.array_join(F.slice("tk", 1, n), " ")
    rows = docs.select("doc_id", "lang", text(5).alias("nm"), F.lower(text(12)).alias("k"), F.coalesce(F.get("tk", F.lit(5)), F.lit("main")).alias("w6"), (F.col("doc_id") % 3).alias("r"))
    ending = F.get(F.array(*map(F.lit, (" Inc.", " LLC", ", Ltd", " & Co", ""))), (F.col("doc_id") % 5).cast("int"))
    address = F.concat((F.length("k") + 1).cast("string"), F.lit(" "), F.col("w6"), F.lit(" St, Ste "), (F.length("k") % 50).cast("string"), F.lit(", "), (F.length("nm") + 10000).cast("string"))
    return rows.select(
        F.concat(F.lit("S"), (F.col("r") + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.concat(F.lit("s"), (F.col("r") + 1).cast("string")).alias("source"),
        F.concat("nm", ending).alias("business_name"),
        F.when((F.col("r") != 0) & (F.col("doc_id") % 29 == 0), None).otherwise(address).alias("business_address"),
        F.when(F.col("doc_id") % 41 == 0, None).when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(F.upper("lang")).alias("country"),
        F.col("k").alias("match_key"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised entities of all sources."""
    return kept(spark, sf_dir, "entities", lambda: normalize_entities(raw_entities(spark, sf_dir).drop("match_key")))


def side(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return entities(spark, sf_dir).where(F.col("source") == source)


def wide_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source1_entity_id, matched_entity_ids``: the sorted comma list of the entities of sources 2 and 3 with the same key, or ''."""

    def make() -> DataFrame:
        raw = raw_entities(spark, sf_dir).select("entity_id", "source", "match_key")
        others = raw.where("source <> 's1'").groupBy("match_key").agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("ids"))
        return raw.where("source = 's1'").join(others, "match_key", "left").select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))

    return kept(spark, sf_dir, "truth", make)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(spark, sf_dir, "records", lambda: ground_truth.truth_records(wide_truth(spark, sf_dir)))


def true_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth in pair form."""
    return ground_truth.targets(records(spark, sf_dir)).select(F.col("s1_id").alias("entity_id_1"), F.col("target_id").alias("entity_id_2"))


def scored(spark: SparkSession, sf_dir: str, right: str, k: int = TOP_K) -> DataFrame:
    """TF-IDF scores of names, to the ``k``-th of each entity."""
    return kept(spark, sf_dir, f"scored-{right}-{k}", lambda: blocking.tfidf_scored(side(spark, sf_dir, "s1"), side(spark, sf_dir, right), k))


def tfidf(spark: SparkSession, sf_dir: str, right: str, k: int = TOP_K, method: str = "tfidf") -> DataFrame:
    rows = scored(spark, sf_dir, right, k).where(F.col("score") >= MIN_SIM)
    return rows.select("entity_id_left", "entity_id_right", F.col("score").alias("blocking_score"), F.lit(method).alias("blocking_method"))


def token_sort(spark: SparkSession, sf_dir: str, right: str, most: int | None = None) -> DataFrame:
    return blocking.token_sort_candidates(side(spark, sf_dir, "s1"), side(spark, sf_dir, right), most=most)


def address_prefix(spark: SparkSession, sf_dir: str, right: str, most: int | None = None) -> DataFrame:
    return blocking.address_prefix_candidates(side(spark, sf_dir, "s1"), side(spark, sf_dir, right), most=most)


def candidates(spark: SparkSession, sf_dir: str, right: str) -> DataFrame:
    """Merged candidates from source 1 to ``right``."""
    parts = lambda: [tfidf(spark, sf_dir, right), token_sort(spark, sf_dir, right, CAP), address_prefix(spark, sf_dir, right, CAP)]
    return kept(spark, sf_dir, f"candidates-{right}", lambda: blocking.merge_candidates(parts(), CAP, canonical=True))


def labeled(spark: SparkSession, sf_dir: str, right: str) -> DataFrame:
    return labeling.assign_labels(candidates(spark, sf_dir, right), records(spark, sf_dir))


def sampled(spark: SparkSession, sf_dir: str, right: str) -> DataFrame:
    return kept(spark, sf_dir, f"sampled-{right}", lambda: labeling.sample_negatives(labeled(spark, sf_dir, right), NegativeSamplingConfig()))


def features(spark: SparkSession, sf_dir: str, right: str, ratios: bool = False) -> DataFrame:
    """Features of the sampled pairs; without ``ratios`` the two that need Python are left out."""
    make = lambda: pair_features(sampled(spark, sf_dir, right), side(spark, sf_dir, "s1"), side(spark, sf_dir, right), ratios)
    return kept(spark, sf_dir, f"features-{right}-{ratios}", make)
