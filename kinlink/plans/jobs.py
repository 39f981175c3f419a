"""The engine's jobs, each from stored tables to stored tables or a report; ``python -m kinlink JOB`` runs one.

Layout below ``Paths``: raw/train_source{1,2,3}.tsv and raw/train_ground_truth.tsv; processed/normalized_s{1,2,3}; candidates/s1_s{2,3};
features/labeled_s1_s{2,3} and features/features_s1_s{2,3}; models; reports.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.config import BlockingConfig, PipelineConfig
from kinlink.operators import audits, blocking, evaluate, experiments, features, ground_truth, labeling, leakage, model, normalize, profiling, recall
from kinlink.operators.recall import ratio
from kinlink.schemas import ENTITY_ID, LEFT
from kinlink.sources import tables

PAIRS = {"S1_S2": "s2", "S1_S3": "s3"}
SOURCES = ("s1", "s2", "s3")
SPOT_CHECKS = {"s2": 3, "s3": 2}


def raw_source(spark: SparkSession, c: PipelineConfig, source: str, rows: int | None = None) -> DataFrame:
    return tables.read_tsv(spark, c.paths.stage("raw") + f"train_source{source[1]}.tsv", rows=rows)


def truth(spark: SparkSession, c: PipelineConfig) -> DataFrame:
    return tables.read_truth(spark, c.paths.stage("raw") + "train_ground_truth.tsv")


def processed(spark: SparkSession, c: PipelineConfig, source: str) -> DataFrame:
    return spark.read.parquet(c.paths.input_stage("processed") + f"normalized_{source}")


def candidates(spark: SparkSession, c: PipelineConfig, right: str) -> DataFrame:
    return spark.read.parquet(c.paths.input_stage("candidates") + f"s1_{right}")


def _report(spark: SparkSession, c: PipelineConfig, name: str, report: Mapping[str, Any]) -> Mapping[str, Any]:
    tables.write_report(spark, report, c.paths.stage("reports") + f"{name}.json")
    return report


def profile(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    """Profiles of the raw sources (``sample_size`` rows of each, 0: all) and of the ground truth's pairs."""
    sources = {s.upper(): raw_source(spark, c, s, c.sample_size or None) for s in SOURCES}
    pairs = ground_truth.targets(ground_truth.truth_records(truth(spark, c))).select(F.col("s1_id").alias("entity_id_1"), F.col("target_id").alias("entity_id_2"))
    made = profiling.run_profiling(sources, pairs)
    return _report(spark, c, "profiling", {k: tables.table_report(v) for k, v in made.items()})


def normalize_sources(spark: SparkSession, c: PipelineConfig) -> None:
    for s in SOURCES:
        tables.write_parquet(normalize.normalize_entities(raw_source(spark, c, s), s), c.paths.stage("processed") + f"normalized_{s}")


def audit(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    """Inventory and all checks of the processed sources, and of the candidates that are there."""
    found = {s: audits.audit_table(processed(spark, c, s), raw_source(spark, c, s), s) for s in SOURCES}
    report: dict[str, Any] = {s: tables.table_report(t) for s, t in found.items()}
    report["passed"] = all(r["passed"] for s in SOURCES for r in report[s])
    report["inventory"] = tables.list_files(spark, c.paths.input_stage("processed"))
    records = ground_truth.truth_records(truth(spark, c))
    report["countries"] = {s: tables.table_report(audits.audit_countries(processed(spark, c, s)))[0] for s in SOURCES}
    for pair_type, right in PAIRS.items():
        if tables.exists(spark, c.paths.input_stage("candidates") + f"s1_{right}"):
            pairs = candidates(spark, c, right)
            report[f"candidates_{right}"] = tables.table_report(audits.audit_candidates(pairs, records))
            report[f"spot_checks_{right}"] = tables.table_report(audits.spot_checks(pairs, records, processed(spark, c, "s1"), processed(spark, c, right), pair_type, SPOT_CHECKS[right]))
    return _report(spark, c, "audit", report)


def block(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    """Candidates from source 1 to the others; an older self-pair output is removed."""
    tables.delete(spark, c.paths.stage("candidates") + "s1_s1")
    s1, report = processed(spark, c, "s1"), {}
    for right in PAIRS.values():
        tables.write_parquet(blocking.block_pair(s1, processed(spark, c, right), c.blocking), c.paths.stage("candidates") + f"s1_{right}")
        report[right] = tables.table_report(blocking.method_counts(candidates(spark, c, right)))
    return _report(spark, c, "blocking", report)


def measure_recall(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    records, report = ground_truth.truth_records(truth(spark, c)), {}
    for pair_type, right in PAIRS.items():
        pairs, s1 = candidates(spark, c, right), processed(spark, c, "s1")
        report[pair_type] = {
            "recall": tables.table_report(recall.evaluate_candidates(records, pairs, pair_type)),
            "by_method": tables.table_report(recall.method_breakdown(records, pairs, pair_type)),
            "by_country": tables.table_report(recall.recall_by_country(records, pairs, s1, pair_type)),
            "address_missing": tables.table_report(recall.address_missing_recall(records, pairs, s1, pair_type)),
            "missing_targets": recall.missing_targets(records, pairs, pair_type).count(),
        }
    return _report(spark, c, "recall", report)


def label(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    records, report = ground_truth.truth_records(truth(spark, c)), {}
    for pair_type, right in PAIRS.items():
        path = c.paths.stage("features") + f"labeled_s1_{right}"
        tables.write_parquet(labeling.labeled_pairs(candidates(spark, c, right), records, c.sampling), path)
        report[pair_type] = tables.table_report(labeling.label_statistics(spark.read.parquet(path), pair_type))
    return _report(spark, c, "labels", report)


def make_features(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    made = []
    for right in PAIRS.values():
        rows = features.pair_features(spark.read.parquet(c.paths.stage("features") + f"labeled_s1_{right}"), processed(spark, c, "s1"), processed(spark, c, right))
        tables.write_parquet(rows, path := c.paths.stage("features") + f"features_s1_{right}")
        made.append(spark.read.parquet(path))
    return _report(spark, c, "feature_stats", {"features": tables.table_report(features.feature_statistics(*made))})


def _train_config(c: PipelineConfig) -> model.TrainConfig:
    return model.TrainConfig(**{k: v for k, v in c.model.items() if k in model.TrainConfig.__dataclass_fields__})


def train(spark: SparkSession, c: PipelineConfig, pair_type: str = "both") -> Mapping[str, Any]:
    """Fit on the features of one pair type or of both; the model, its metrics and importances are stored."""
    paths = [c.paths.stage("features") + f"features_s1_{r}" for p, r in PAIRS.items() if pair_type in ("both", p)]
    rows = tables.load_features(spark, paths, pair_type)
    config = _train_config(c)
    fitted, metrics, report = model.train_and_evaluate(rows, config)
    fitted.write().overwrite().save(c.paths.stage("models") + f"gbt_{pair_type}")
    scored = model.score(fitted, evaluate.entity_split(rows, config.validation_fraction, config.seed).where("is_validation"))
    grid = evaluate.threshold_grid(*(float(c.threshold[k]) for k in ("min", "max", "step"))) if c.threshold else evaluate.threshold_grid()
    best = tables.table_report(evaluate.best_threshold(scored, grid))
    return _report(spark, c, f"metrics_{pair_type}", {**report, "metrics": tables.table_report(metrics), "best_threshold": best})


def diagnose(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    """Does the model lean on how pairs were found? Scores by kind of pair, importances, and a model of texts alone."""
    rows = tables.load_features(spark, [c.paths.stage("features") + f"features_s1_{r}" for r in PAIRS.values()])
    labeled = reduce(DataFrame.unionByName, (spark.read.parquet(c.paths.stage("features") + f"labeled_s1_{r}") for r in PAIRS.values()))
    _, _, full = model.train_and_evaluate(rows, _train_config(c))
    _, metrics, _ = model.train_and_evaluate(rows, _train_config(c), model.text_features())
    auc = metrics.where("grp = 'ALL'").select("roc_auc").first()
    report = {
        "importance": leakage.metadata_share([(n, g) for n, g, _ in full["importance"]]),
        "text_only_auc": auc and auc[0],
        "text_only": leakage.text_only_verdict((auc and auc[0]) or 0.0),
        **{k: tables.table_report(f(labeled)) for k, f in (("scores", leakage.score_distribution), ("overlap", leakage.score_overlap), ("gap", leakage.entity_gap))},
    }
    return _report(spark, c, "leakage", report)


def compare_blocking(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    """The 21 experiments, for both pair types, with countries."""
    runs = experiments.all_experiments(c.blocking.tfidf_top_k, c.blocking.max_candidates_per_entity)
    names = sorted({p for e in runs for p in e.parts})
    left, records = processed(spark, c, "s1"), ground_truth.truth_records(truth(spark, c))
    found, countries = {}, {}
    for pair_type, right in PAIRS.items():
        strategies = experiments.strategy_tables(left, processed(spark, c, right), names, c.blocking.tfidf_top_k, most=max(e.cap for e in runs))
        path = tables.scratch_path(spark, f"runs-{right}")
        tables.write_parquet(experiments.run_candidates(runs, strategies), path)
        experiments.release(strategies)
        pairs = spark.read.parquet(path)
        found[pair_type] = experiments.evaluate_runs(runs, pairs, records, left, pair_type)
        countries[pair_type] = tables.table_report(experiments.country_breakdown(pairs, records, left, pair_type))
    table = experiments.tradeoff_table(found["S1_S2"], found["S1_S3"])
    return _report(spark, c, "experiments", {"tradeoff": tables.table_report(table), "countries": countries})


def dev_sample(sources: Mapping[str, DataFrame], wide_truth: DataFrame, n_matched: int = 2000, n_single: int = 200, seed: int = 42, config: BlockingConfig | None = None) -> DataFrame:
    """Recall on drawn entities and the pools of their true matches: ``pair_type, n_entities, targets, found, recall_pct, avg_candidates``."""
    records = ground_truth.truth_records(wide_truth)
    chosen = labeling.stratified_entities(records, n_matched, n_single, seed).select("s1_id")
    records = records.join(chosen, "s1_id", "left_semi")
    gold = ground_truth.targets(records)
    left = normalize.normalize_entities(tables.keep_ids(sources["s1"], chosen.withColumnRenamed("s1_id", ENTITY_ID)), "s1")
    out = []
    for pair_type, right in PAIRS.items():
        pool = normalize.normalize_entities(tables.keep_ids(sources[right], gold.where(F.col("target_source") == right).select(F.col("target_id").alias(ENTITY_ID))), right)
        pairs = blocking.block_pair(left, pool, config)
        hits = recall.target_hits(records, pairs, pair_type).agg(F.coalesce(F.sum("n_targets"), F.lit(0)).alias("targets"), F.coalesce(F.sum("n_found"), F.lit(0)).alias("found"))
        volume = pairs.agg(F.count(LEFT).alias("n_pairs")).join(F.broadcast(records.agg(F.count("*").alias("n_entities"))))
        share = F.round(ratio(F.col("found") * 100.0, F.col("targets")), 2)
        out.append(hits.join(F.broadcast(volume)).select(F.lit(pair_type).alias("pair_type"), "n_entities", "targets", "found", share.alias("recall_pct"), ratio(F.col("n_pairs"), F.col("n_entities")).alias("avg_candidates")))
    return reduce(DataFrame.unionByName, out)


def sample_recall(spark: SparkSession, c: PipelineConfig) -> Mapping[str, Any]:
    rows = dev_sample({s: raw_source(spark, c, s) for s in SOURCES}, truth(spark, c), config=c.blocking)
    return _report(spark, c, "dev_sample", {"recall": tables.table_report(rows)})


JOBS = {
    "profile": profile, "normalize": normalize_sources, "audit": audit, "block": block, "recall": measure_recall, "label": label, "features": make_features, "train": train, "diagnose": diagnose,
    "experiments": compare_blocking, "dev-sample": sample_recall,
}
