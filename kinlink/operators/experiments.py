"""Blocking experiments: 21 stacks of strategies, compared by recall and volume.

Each strategy's candidates are made once, at the largest setting, with a rank; every run is a filter of them. All runs are one
table: ``experiment`` is a column of the candidates, and recall is counted for all experiments together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlink.operators import blocking
from kinlink.operators.ground_truth import source_of, targets, true_among
from kinlink.operators.recall import ratio
from kinlink.schemas import COUNTRY, ENTITY_ID, LEFT, METHOD, PAIR_TARGETS, RIGHT, SCORE

TOP_KS, RARITIES, CAPS = (10, 25, 50, 100), (0.001, 0.005, 0.01), (50, 100, 200)


@dataclass(frozen=True)
class Experiment:
    """``parts``: strategies by name, with a TF-IDF rank limit where given; ``cap``: candidates of an entity at most."""

    name: str
    group: int
    parts: tuple[str, ...]
    cap: int = 100
    top_k: int | None = None


def all_experiments(top_k: int = 50, cap: int = 100) -> list[Experiment]:
    """The 21 runs in order."""
    three = ("tfidf_name", "token_sort", "address_prefix")
    out = [Experiment(f"exp1a_tfidf_topk_{k}", 1, ("tfidf_name",), cap, k) for k in TOP_KS]
    out += [Experiment(f"exp1b_rare_token_{r}", 1, (f"rare_token_{r}",), cap) for r in RARITIES]
    out += [Experiment(f"exp1c_global_cap_{c}", 1, three, c, max(CAPS)) for c in CAPS]
    out += [Experiment("exp2a_union_baseline", 2, three, cap, top_k), Experiment("exp2a_weighted_tfidf_priority", 2, ("tfidf_boosted", *three[1:]), cap, top_k)]
    drops = {"all3": three, "drop_token_sort": (three[0], three[2]), "drop_address": three[:2], "drop_tfidf": three[1:], "name_only": three[:2]}
    out += [Experiment(f"exp2b_{n}", 2, p, cap, top_k) for n, p in drops.items()]
    out += [Experiment("exp3a_postal_char_ngram", 3, ("postal_ngram",), cap)]
    out += [Experiment(f"exp3b_country_tfidf_{x}", 3, (f"country_tfidf_{x}",), cap) for x in ("name", "addr")]
    return [*out, Experiment("exp3c_addr_missing_name_only_quality", 3, ("tfidf_name", "token_sort", "rare_token_0.005"), cap, top_k)]


def strategy_tables(left: DataFrame, right: DataFrame, names: Sequence[str], top_k: int = 50, largest_k: int = max(CAPS), min_similarity: float = 0.05, most: int | None = None) -> dict[str, DataFrame]:
    """Candidates of each strategy, with ``rank`` (1 where a strategy has none). ``most``: the largest cap of the runs."""
    out: dict[str, DataFrame] = {}
    if any(n.startswith("tfidf") for n in names):
        scored = blocking.tfidf_scored(left, right, largest_k)
        place = F.row_number().over(Window.partitionBy(LEFT).orderBy(F.col("score").desc(), RIGHT))
        ranked = scored.withColumn("rank", place).where((F.col("score") >= min_similarity) & (F.col(LEFT) != F.col(RIGHT)))
        base = ranked.select(LEFT, RIGHT, F.col("score").alias(SCORE), F.lit("tfidf_name").alias(METHOD), "rank").persist()
        out |= {"tfidf_name": base, "tfidf_boosted": blocking.boosted(base)}
    whole = {
        "token_sort": lambda: blocking.token_sort_candidates(left, right, most=most),
        "address_prefix": lambda: blocking.address_prefix_candidates(left, right, most=most).withColumn(METHOD, F.lit("address_prefix")),
        "postal_ngram": lambda: blocking.postal_ngram_candidates(left, right, top_k, min_similarity),
        "country_tfidf_name": lambda: blocking.country_tfidf_candidates(left, right, top_k, method="country_tfidf_name"),
        "country_tfidf_addr": lambda: blocking.country_tfidf_candidates(left.where("not address_missing"), right.where("not address_missing"), top_k, text_col="normalized_address", method="country_tfidf_addr"),
    }
    whole |= {f"rare_token_{r}": (lambda r=r: blocking.rare_token_candidates(left, right, r)) for r in RARITIES}
    for n in names:
        if n not in out:
            out[n] = whole[n]().withColumn("rank", F.lit(1)).persist()
    return out


def release(strategies: Mapping[str, DataFrame]) -> None:
    """Give back the memory of strategies' tables, once the runs made of them are stored."""
    for table in strategies.values():
        table.unpersist()


def run_candidates(experiments: Sequence[Experiment], tables: Mapping[str, DataFrame]) -> DataFrame:
    """``experiment, entity_id_left, entity_id_right``: merged and capped pairs of all experiments."""
    runs: dict[str, list[tuple[str, int, int]]] = {}
    for e in experiments:
        for p in e.parts:
            runs.setdefault(p, []).append((e.name, e.top_k or (1 << 30), e.cap))
    parts = []
    for p, wanted in runs.items():
        each = F.array(*(F.struct(F.lit(n).alias("experiment"), F.lit(k).alias("k"), F.lit(cap).alias("cap")) for n, k, cap in wanted))
        parts.append(tables[p].select(LEFT, RIGHT, SCORE, "rank", F.explode(each).alias("e")).where(F.col("rank") <= F.col("e.k")).select("e.experiment", "e.cap", LEFT, RIGHT, SCORE))
    merged = reduce(DataFrame.unionByName, parts).groupBy("experiment", "cap", LEFT, RIGHT).agg(F.max(SCORE).alias(SCORE))
    at = F.row_number().over(Window.partitionBy("experiment", LEFT).orderBy(F.col(SCORE).desc(), RIGHT))
    return merged.withColumn("_at", at).where(F.col("_at") <= F.col("cap")).select("experiment", LEFT, RIGHT)


def evaluate_runs(experiments: Sequence[Experiment], pairs: DataFrame, records: DataFrame, left: DataFrame, pair_type: str) -> DataFrame:
    """One row for each experiment: recall, recall of entities without address, mean and total candidates, candidates of singletons."""
    source = PAIR_TARGETS[pair_type]
    bare = left.where("address_missing").select(F.col(ENTITY_ID).alias(LEFT), F.lit(1).alias("bare")).distinct()
    # targets are counted in their lists; only those among the pairs are rows
    sizes = records.select(F.col("s1_id").alias(LEFT), F.size(F.filter("targets", lambda x: source_of(x) == source)).alias("n")).where("n > 0").join(bare, LEFT, "left")
    zeros = lambda c: F.coalesce(F.sum(c), F.lit(0))
    totals = sizes.agg(zeros("n").alias("n_targets"), zeros(F.col("n") * F.col("bare")).alias("n_bare"))
    gold = true_among(records, pairs, LEFT, RIGHT).where(source_of(F.col(RIGHT)) == source).join(bare, LEFT, "left")
    hits = pairs.join(gold, [LEFT, RIGHT]).groupBy("experiment").agg(F.count("*").alias("found"), F.count("bare").alias("found_bare"))
    with_targets = sizes.select(LEFT, F.lit(1).alias("has")).distinct()
    listed = records.select(F.col("s1_id").alias(LEFT), F.lit(1).alias("listed"))
    volume = pairs.groupBy("experiment", LEFT).agg(F.count("*").alias("n")).join(with_targets, LEFT, "left").join(listed, LEFT, "left")
    sums = volume.groupBy("experiment").agg(F.sum("n").alias("total_candidates"), F.avg("n").alias("avg_candidates"), F.sum(F.when(F.col("has").isNull() & F.col("listed").isNotNull(), F.col("n"))).alias("singleton_volume"))
    names = records.sparkSession.createDataFrame([(i, e.name, e.group) for i, e in enumerate(experiments)], "run int, experiment string, experiment_set int")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return names.join(sums, "experiment", "left").join(hits, "experiment", "left").join(F.broadcast(totals)).select(
        "run",
        "experiment",
        "experiment_set",
        F.lit(pair_type).alias("pair_type"),
        ratio(zero("found"), F.col("n_targets")).alias("recall"),
        F.when(F.col("n_bare") > 0, zero("found_bare") / F.col("n_bare")).alias("address_missing_recall"),
        F.coalesce("avg_candidates", F.lit(0.0)).alias("avg_candidates"),
        zero("total_candidates").alias("total_candidates"),
        zero("singleton_volume").alias("singleton_volume"),
    )


def tradeoff_table(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """Both pair types side by side, rounded, with a recommendation for each run."""
    of = lambda df, t: df.select("run", "experiment", "experiment_set", *(F.col(c).alias(f"{c}_{t}") for c in ("recall", "address_missing_recall", "avg_candidates", "total_candidates", "singleton_volume")))
    rows = of(s2, "S1_S2").join(of(s3, "S1_S3").drop("experiment", "experiment_set"), "run")
    mean = (F.col("recall_S1_S2") + F.col("recall_S1_S3")) / 2
    bare = (F.coalesce("address_missing_recall_S1_S2", F.lit(0.0)) + F.coalesce("address_missing_recall_S1_S3", F.lit(0.0))) / 2
    rows = rows.withColumn("mean", mean)
    base = rows.where("experiment = 'exp2a_union_baseline'").agg(F.max("mean").alias("base"))
    name = F.col("experiment")
    advice = (
        F.when(name == "exp2a_union_baseline", "keep")
        .when(name == "exp2a_weighted_tfidf_priority", F.when(F.col("mean") >= F.coalesce("base", F.lit(0.0)), "keep").otherwise("drop"))
        .when(name.startswith("exp3a") | name.startswith("exp3b"), F.when(F.col("mean") > 0.1, "tune-further").otherwise("drop"))
        .when(name.startswith("exp3c"), F.when(bare > 0.5, "keep").otherwise("tune-further"))
        .otherwise("tune-further")
    )
    r = lambda c, n: F.round(c, n).alias(c)
    return rows.join(F.broadcast(base)).select(
        "run", "experiment", "experiment_set", r("recall_S1_S2", 4), r("recall_S1_S3", 4), F.round("mean", 4).alias("avg_recall"), r("address_missing_recall_S1_S2", 6), r("address_missing_recall_S1_S3", 6),
        r("avg_candidates_S1_S2", 1), r("avg_candidates_S1_S3", 1), "total_candidates_S1_S2", "total_candidates_S1_S3", "singleton_volume_S1_S2", "singleton_volume_S1_S3", advice.alias("recommendation"),
    )


def country_breakdown(pairs: DataFrame, records: DataFrame, left: DataFrame, pair_type: str, top_n: int = 10) -> DataFrame:
    """For each experiment the ``top_n`` raw countries with the most targets: targets, found, recall to 4 places."""
    country = F.coalesce(F.col(COUNTRY), F.lit("unknown")) if COUNTRY in left.columns else F.lit("unknown")
    of = left.select(F.col(ENTITY_ID).alias(LEFT), country.alias("country"))
    gold = targets(records).where(F.col("target_source") == PAIR_TARGETS[pair_type]).select(F.col("s1_id").alias(LEFT), F.col("target_id").alias(RIGHT)).join(of, LEFT, "left").withColumn("country", F.coalesce("country", F.lit("unknown")))
    top = gold.groupBy("country").agg(F.count("*").alias("total_gt_targets")).orderBy(F.col("total_gt_targets").desc(), "country").limit(top_n)
    found = pairs.join(gold, [LEFT, RIGHT]).groupBy("experiment", "country").agg(F.count("*").alias("found"))
    runs = pairs.select("experiment").distinct().join(F.broadcast(top))
    n = F.coalesce("found", F.lit(0))
    return runs.join(found, ["experiment", "country"], "left").select("experiment", "country", "total_gt_targets", n.alias("found"), F.round(n / F.col("total_gt_targets"), 4).alias("recall"))
