"""Labels for candidates and the choice of negatives.

Draws are by the order of ``md5(seed|ids)``, so they repeat on any cluster and in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.config import NegativeSamplingConfig
from kinlink.operators.ground_truth import singletons, source_of, true_among
from kinlink.schemas import CANDIDATE_ID, CANDIDATE_SOURCE, LEFT, METHOD, RIGHT, S1_ID, SCORE

LABELED = [S1_ID, CANDIDATE_ID, CANDIDATE_SOURCE, SCORE, METHOD, "label", "negative_type"]


def draw(seed: int, *ids: str) -> Column:
    """The seeded order of rows."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(i) for i in ids)))


def assign_labels(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Label 1 for targets; candidates of a singleton are ``singleton_negative``, all others ``unsampled_negative``.

    An entity that the ground truth doesn't list is no singleton. A candidate without a known source prefix is an error.
    """
    rows = candidates.select(F.col(LEFT).alias(S1_ID), F.col(RIGHT).alias(CANDIDATE_ID), source_of(F.col(RIGHT), strict=True).alias(CANDIDATE_SOURCE), SCORE, METHOD)
    gold = true_among(records, rows, S1_ID, CANDIDATE_ID).withColumn("is_target", F.lit(1))
    alone = singletons(records).select(F.col("s1_id").alias(S1_ID), F.lit(1).alias("is_single"))
    met = rows.join(gold, [S1_ID, CANDIDATE_ID], "left").join(alone, S1_ID, "left")
    kind = F.when(F.col("is_single").isNotNull(), "singleton_negative").when(F.col("is_target").isNotNull(), "positive").otherwise("unsampled_negative")
    return met.withColumn("negative_type", kind).withColumn("label", (F.col("negative_type") == "positive").cast("int")).select(*LABELED)


def sample_negatives(labeled: DataFrame, config: NegativeSamplingConfig | None = None, distinct: bool = False) -> DataFrame:
    """All positives and singleton negatives, and drawn hard and easy negatives of entities with a positive among their candidates.

    Hard: within ``hard_delta`` of the entity's best positive score, or within twice that if there are none so near. Easy: at or below the
    ``easy_percentile`` of its negatives' scores. A row can be drawn as both and is then there twice, unless ``distinct``: then it
    stays as hard. Other negatives go.
    """
    c = config or NegativeSamplingConfig()
    positive = F.col("label") == 1
    per = labeled.where(positive).groupBy(S1_ID).agg(F.max(SCORE).alias("tp_max"), F.count("*").alias("n_pos"))
    negatives = labeled.where(F.col("negative_type") == "unsampled_negative")
    floor = lambda times: F.greatest(F.lit(0.0), F.round(F.col("tp_max") - c.hard_delta * times, 9))
    rows = negatives.join(per, S1_ID)
    near = F.max((F.col(SCORE) >= floor(1)).cast("int")).alias("any_near")
    stats = rows.groupBy(S1_ID).agg(F.round(F.percentile(SCORE, c.easy_percentile), 9).alias("easy_most"), near)
    rows = rows.join(stats, S1_ID).withColumn("draw", draw(c.seed, S1_ID, CANDIDATE_ID))

    def drawn(pool: Column, times: int, name: str) -> DataFrame:
        at = F.row_number().over(Window.partitionBy(S1_ID).orderBy("draw", CANDIDATE_ID))
        return rows.where(pool).withColumn("_at", at).where(F.col("_at") <= times * F.col("n_pos")).withColumn("negative_type", F.lit(name)).select(*LABELED)

    hard = drawn(F.col(SCORE) >= F.when(F.col("any_near") == 1, floor(1)).otherwise(floor(2)), c.hard_per_positive, "hard_negative")
    easy = drawn(F.col(SCORE) <= F.col("easy_most"), c.easy_per_positive, "easy_negative")
    if distinct:
        easy = easy.join(hard, [S1_ID, CANDIDATE_ID], "left_anti").select(*LABELED)
    kept = labeled.where(positive | (F.col("negative_type") == "singleton_negative")).select(*LABELED)
    return kept.unionByName(hard).unionByName(easy)


def labeled_pairs(candidates: DataFrame, records: DataFrame, config: NegativeSamplingConfig | None = None) -> DataFrame:
    return sample_negatives(assign_labels(candidates, records), config)


def label_statistics(labeled: DataFrame, pair_type: str) -> DataFrame:
    """One row of counts and rates."""
    n = lambda cond: F.count(F.when(cond, 1))
    kind = lambda name: n(F.col("negative_type") == name)
    pos, neg = n(F.col("label") == 1), n(F.col("label") == 0)
    return labeled.agg(
        F.lit(pair_type).alias("pair_type"),
        F.count("*").alias("total_pairs"),
        pos.alias("positives"),
        neg.alias("negatives"),
        kind("hard_negative").alias("hard_negatives"),
        kind("easy_negative").alias("easy_negatives"),
        kind("singleton_negative").alias("singleton_negatives"),
        F.round(neg / F.greatest(pos, F.lit(1)), 2).alias("imbalance_ratio"),
        F.round(pos * 100.0 / F.greatest(F.count("*"), F.lit(1)), 2).alias("positive_rate_pct"),
    )


def stratified_entities(records: DataFrame, n_matched: int = 2000, n_single: int = 200, seed: int = 42) -> DataFrame:
    """``s1_id, is_singleton`` of so many drawn entities of each kind."""
    rows = records.select("s1_id", "is_singleton")
    # each kind by a limit of its own, so that no task sorts more than the best of the others
    taken = lambda kind, n: rows.where(kind).orderBy(draw(seed, "s1_id"), "s1_id").limit(n)
    return taken(~F.col("is_singleton"), n_matched).unionByName(taken(F.col("is_singleton"), n_single))
