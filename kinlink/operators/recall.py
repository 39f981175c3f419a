"""How many true pairs the candidates hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.operators.ground_truth import source_of, targets
from kinlink.schemas import COUNTRY, ENTITY_ID, LEFT, METHOD, PAIR_TARGETS, RIGHT


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def unordered(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs, the smaller id first."""
    return df.select(F.least(a, b).alias("id_low"), F.greatest(a, b).alias("id_high")).distinct()


def pair_recall(candidates: DataFrame, truth: DataFrame, left: str = "entity_id_1", right: str = "entity_id_2") -> DataFrame:
    """One row: recall and precision over unordered pairs, and the mean number of candidate rows of a left id."""
    found = unordered(candidates, LEFT, RIGHT).withColumn("c", F.lit(1)).join(unordered(truth, left, right).withColumn("t", F.lit(1)), ["id_low", "id_high"], "full")
    counts = found.agg(F.count("t").alias("total_gt_pairs"), F.count(F.when(F.col("c").isNotNull(), F.col("t"))).alias("found_pairs"), F.count("c").alias("total_candidates"))
    mean = candidates.groupBy(LEFT).count().agg(F.coalesce(F.avg("count"), F.lit(0.0)).alias("avg_candidates_per_entity"))
    both = counts.join(F.broadcast(mean))
    return both.select(
        "total_gt_pairs",
        "found_pairs",
        (F.col("total_gt_pairs") - F.col("found_pairs")).alias("missing_pairs"),
        "total_candidates",
        ratio(F.col("found_pairs"), F.col("total_gt_pairs")).alias("recall"),
        ratio(F.col("found_pairs"), F.col("total_candidates")).alias("precision"),
        "avg_candidates_per_entity",
    )


def missing_pairs(candidates: DataFrame, truth: DataFrame, left: str = "entity_id_1", right: str = "entity_id_2") -> DataFrame:
    """True pairs that aren't candidates."""
    lost = unordered(truth, left, right).join(unordered(candidates, LEFT, RIGHT), ["id_low", "id_high"], "left_anti")
    return lost.select(F.col("id_low").alias(left), F.col("id_high").alias(right))


def coverage_by_method(candidates: DataFrame, truth: DataFrame, left: str = "entity_id_1", right: str = "entity_id_2") -> DataFrame:
    """For each method: the rows whose method text contains it, and the true pairs among them.

    Containment is by substring, so ``tfidf`` also counts rows of ``tfidf_name``. A combination of methods is matched with the method names once,
    not for every row.
    """
    combos = candidates.groupBy(METHOD).count()
    methods = combos.select(F.explode(F.split(METHOD, r"\+")).alias("method")).distinct()
    # both sides have a row for each combination or name of methods, not for each candidate
    belongs = combos.join(F.broadcast(methods), F.col(METHOD).contains(F.col("method"))).select("method", METHOD, "count")
    rows = belongs.groupBy("method").agg(F.sum("count").alias("candidates"))
    pairs = candidates.select(F.least(LEFT, RIGHT).alias("id_low"), F.greatest(LEFT, RIGHT).alias("id_high"), METHOD).distinct()
    gold = unordered(truth, left, right)
    true_rows = pairs.join(gold, ["id_low", "id_high"]).join(belongs, METHOD)
    found = true_rows.select("method", "id_low", "id_high").distinct().groupBy("method").agg(F.count("*").alias("found"))
    totals = gold.join(pairs.select("id_low", "id_high", F.lit(1).alias("c")).distinct(), ["id_low", "id_high"], "left").agg(F.count("*").alias("total"), F.count("c").alias("total_found"))
    n = F.coalesce(F.col("found"), F.lit(0))
    share = lambda b: F.round(ratio(n * 100.0, F.col(b)), 2)
    return rows.join(found, "method", "left").join(F.broadcast(totals)).select("method", "candidates", n.alias("gt_pairs_found"), share("total").alias("pct_of_total_gt"), share("total_found").alias("pct_of_found_gt"))


def distinct_pairs(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col(LEFT).alias("s1_id"), F.col(RIGHT).alias("target_id")).distinct()


def target_hits(records: DataFrame, candidates: DataFrame, pair_type: str) -> DataFrame:
    """``s1_id, n_targets, n_found`` of the entities with targets of this type."""
    gold = targets(records).where(F.col("target_source") == PAIR_TARGETS[pair_type])
    met = gold.join(distinct_pairs(candidates).withColumn("hit", F.lit(1)), ["s1_id", "target_id"], "left")
    return met.groupBy("s1_id").agg(F.count("*").alias("n_targets"), F.count("hit").alias("n_found"))


def evaluate_candidates(records: DataFrame, candidates: DataFrame, pair_type: str) -> DataFrame:
    """One row: recall over targets. Entities without targets of this type count as singletons, with their candidates, and not in recall."""
    volume = distinct_pairs(candidates).groupBy("s1_id").agg(F.count("*").alias("n_cands"))
    hits = target_hits(records, candidates, pair_type)
    per_entity = records.select("s1_id").join(hits, "s1_id", "left").join(volume, "s1_id", "left")
    alone = F.col("n_targets").isNull()
    gold = per_entity.agg(
        F.count("n_targets").alias("s1_entities_in_gt"),
        F.coalesce(F.sum("n_targets"), F.lit(0)).alias("total_gt_targets"),
        F.coalesce(F.sum("n_found"), F.lit(0)).alias("found_targets"),
        F.count(F.when(alone, 1)).alias("singleton_s1_count"),
        F.coalesce(F.sum(F.when(alone, F.col("n_cands"))), F.lit(0)).alias("singleton_cand_vol"),
    )
    totals = volume.agg(F.coalesce(F.sum("n_cands"), F.lit(0)).alias("total_candidates"), F.coalesce(F.avg("n_cands"), F.lit(0.0)).alias("avg_candidates_per_entity"))
    return gold.join(F.broadcast(totals)).select(
        F.lit(pair_type).alias("pair_type"),
        "s1_entities_in_gt",
        "total_gt_targets",
        "found_targets",
        ratio(F.col("found_targets"), F.col("total_gt_targets")).alias("recall"),
        "total_candidates",
        "avg_candidates_per_entity",
        "singleton_s1_count",
        "singleton_cand_vol",
    )


def evaluate_key_candidates(records: DataFrame, left: DataFrame, right: DataFrame, key: Column, pair_type: str) -> DataFrame:
    """``evaluate_candidates`` of all pairs with equal keys, which aren't made: keys are counted, and of equal entities the targets are looked at once.

    Entities with the same key and the same targets are one group, so a key of n left and n right ids costs n rows, not n * n. Where an id has
    several keys, pairs could count twice; then they are made.
    """
    of = lambda df: df.select(F.col(ENTITY_ID).alias("id"), key.alias("key")).where("key is not null").distinct()
    lefts, rights = of(left), of(right)
    several = lambda df: df.groupBy("id").count().where("count > 1").select("id")
    if not several(lefts).unionByName(several(rights)).isEmpty():
        met = lefts.withColumnRenamed("id", LEFT).join(rights.withColumnRenamed("id", RIGHT), "key").where(F.col(LEFT) != F.col(RIGHT))
        return evaluate_candidates(records, met, pair_type)
    itself = rights.withColumn("itself", F.lit(1))
    known = lefts.join(rights.groupBy("key").agg(F.count("*").alias("n_right")), "key", "left").join(itself, ["id", "key"], "left")
    known = known.select("id", "key", (F.coalesce("n_right", F.lit(0)) - F.coalesce("itself", F.lit(0))).alias("n_cands"))
    totals = known.where("n_cands > 0").agg(F.coalesce(F.sum("n_cands"), F.lit(0)).alias("total_candidates"), F.coalesce(F.avg("n_cands"), F.lit(0.0)).alias("avg_candidates_per_entity"))
    listed = records.select(F.col("s1_id").alias("id"), F.filter("targets", lambda x: source_of(x) == PAIR_TARGETS[pair_type]).alias("list"))
    groups = listed.join(known, "id", "left").groupBy("key", F.size("list").alias("n_targets"), F.filter("list", lambda x: x != F.col("id")).alias("others"))
    groups = groups.agg(F.count("*").alias("n"), F.sum("n_cands").alias("cands"))
    some = F.col("n_targets") > 0
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    gold = groups.agg(
        total(F.when(some, F.col("n"))).alias("s1_entities_in_gt"),
        total(F.col("n") * F.col("n_targets")).alias("total_gt_targets"),
        total(F.when(~some, F.col("n"))).alias("singleton_s1_count"),
        total(F.when(~some, F.col("cands"))).alias("singleton_cand_vol"),
    )
    hits = groups.where("key is not null").select("key", "n", F.explode("others").alias("id")).join(rights, ["id", "key"]).agg(total("n").alias("found_targets"))
    return gold.join(F.broadcast(hits)).join(F.broadcast(totals)).select(
        F.lit(pair_type).alias("pair_type"), "s1_entities_in_gt", "total_gt_targets", "found_targets", ratio(F.col("found_targets"), F.col("total_gt_targets")).alias("recall"), "total_candidates", "avg_candidates_per_entity",
        "singleton_s1_count", "singleton_cand_vol",
    )


def method_breakdown(records: DataFrame, candidates: DataFrame, pair_type: str) -> DataFrame:
    """Targets found by each method, by direction."""
    gold = targets(records).where(F.col("target_source") == PAIR_TARGETS[pair_type]).select(F.col("s1_id").alias("entity_id_1"), F.col("target_id").alias("entity_id_2"))
    return coverage_by_method(candidates, gold).select("method", "gt_pairs_found", "pct_of_total_gt")


def missing_targets(records: DataFrame, candidates: DataFrame, pair_type: str) -> DataFrame:
    """Targets that no candidate names."""
    gold = targets(records).where(F.col("target_source") == PAIR_TARGETS[pair_type]).select("s1_id", "target_id")
    return gold.join(distinct_pairs(candidates), ["s1_id", "target_id"], "left_anti")


def address_missing_recall(records: DataFrame, candidates: DataFrame, s1: DataFrame, pair_type: str) -> DataFrame:
    """One row: recall over the entities without address; null if they have no targets."""
    chosen = s1.where("address_missing").select(F.col(ENTITY_ID).alias("s1_id")).distinct()
    hits = target_hits(records, candidates, pair_type).join(chosen, "s1_id", "left_semi")
    total, found = F.coalesce(F.sum("n_targets"), F.lit(0)), F.coalesce(F.sum("n_found"), F.lit(0))
    return hits.agg(F.count("*").alias("n_entities"), total.alias("total_gt_targets"), found.alias("found_targets"), F.try_divide(found.cast("double"), total).alias("recall"))


def recall_by_country(records: DataFrame, candidates: DataFrame, s1: DataFrame, pair_type: str, top_n: int = 10) -> DataFrame:
    """Recall in the ``top_n`` raw countries with the most targets (ties by country); null and absent countries are ``unknown``."""
    country = F.coalesce(F.col(COUNTRY), F.lit("unknown")) if COUNTRY in s1.columns else F.lit("unknown")
    of = s1.select(F.col(ENTITY_ID).alias("s1_id"), country.alias("country"))
    rows = target_hits(records, candidates, pair_type).join(of, "s1_id", "left").withColumn("country", F.coalesce("country", F.lit("unknown")))
    stats = rows.groupBy("country").agg(F.count("*").alias("s1_entities"), F.sum("n_targets").alias("total_gt_targets"), F.sum("n_found").alias("found"))
    top = stats.orderBy(F.col("total_gt_targets").desc(), "country").limit(top_n)
    return top.withColumn("recall", F.round(F.try_divide(F.col("found").cast("double"), F.col("total_gt_targets")), 4))
