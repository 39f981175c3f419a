"""Does the model tell matches by likeness, or by how the pairs were sampled?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.features import METADATA
from kinlink.schemas import S1_ID, SCORE


def score_distribution(labeled: DataFrame) -> DataFrame:
    """Quantiles and mean of the blocking score for each kind of pair."""
    q = F.percentile(SCORE, F.array(*map(F.lit, (0.05, 0.25, 0.5, 0.75, 0.95))))
    s = labeled.groupBy("negative_type").agg(F.count("*").alias("n"), F.min(SCORE).alias("lo"), F.max(SCORE).alias("hi"), F.avg(SCORE).alias("m"), q.alias("q"))
    r4 = lambda c, name: F.round(c, 4).alias(name)
    at = lambda i, name: r4(F.col("q")[i], name)
    return s.select("negative_type", "n", r4(F.col("lo"), "min"), at(0, "p5"), at(1, "p25"), at(2, "median"), at(3, "p75"), at(4, "p95"), r4(F.col("hi"), "max"), r4(F.col("m"), "mean"))


def score_overlap(labeled: DataFrame) -> DataFrame:
    """One row: hard negatives at or above the lowest positive, positives below the median hard negative, and whether ranges meet."""
    kind = lambda name: F.when(F.col("negative_type") == name, F.col(SCORE))
    tp, hard = kind("positive"), kind("hard_negative")
    marks = labeled.agg(F.min(tp).alias("tp_min"), F.max(tp).alias("tp_max"), F.min(hard).alias("hard_min"), F.max(hard).alias("hard_max"), F.median(hard).alias("hard_median"), F.count(tp).alias("n_tp"), F.count(hard).alias("n_hard"))
    counts = labeled.join(F.broadcast(marks)).agg(
        F.count(F.when(hard >= F.col("tp_min"), 1)).alias("hard_over"), F.count(F.when(tp < F.col("hard_median"), 1)).alias("tp_under")
    )
    pct = lambda a, b, name: F.round(F.try_divide(F.col(a) * 100.0, F.col(b)), 4).alias(name)
    meets = (F.col("hard_max") >= F.col("tp_min")) & (F.col("tp_max") >= F.col("hard_min"))
    return marks.join(F.broadcast(counts)).select("n_tp", "n_hard", pct("hard_over", "n_hard", "pct_hard_ge_tp_min"), pct("tp_under", "n_tp", "pct_tp_lt_hard_median"), F.coalesce(meets, F.lit(False)).alias("ranges_overlap"))


def entity_gap(labeled: DataFrame) -> DataFrame:
    """One row over entities with both: best positive minus best hard negative; how often below 0, its median and 5th percentile."""
    best = labeled.groupBy(S1_ID).agg(*(F.max(F.when(F.col("negative_type") == k, F.col(SCORE))).alias(n) for k, n in (("positive", "tp"), ("hard_negative", "hard"))))
    gaps = best.where("tp is not null and hard is not null").select(F.round(F.col("tp") - F.col("hard"), 9).alias("gap"))
    return gaps.agg(F.count("*").alias("n_entities"), F.count(F.when(F.col("gap") < 0, 1)).alias("n_negative_gap"), F.round(F.median("gap"), 4).alias("median_gap"), F.round(F.percentile("gap", 0.05), 4).alias("p5_gap"))


def metadata_share(importance: Sequence[tuple[str, float]]) -> dict[str, object]:
    """Share of gain of the features that tell how a pair was found, their places, and a verdict."""
    ranked = sorted(importance, key=lambda x: (-x[1], x[0]))
    total = sum(g for _, g in ranked) or 1.0
    share = 100.0 * sum(g for f, g in ranked if f in METADATA) / total
    top = lambda n: [f for f, _ in ranked[:n] if f in METADATA]
    verdict = "leakage likely" if share > 50 else "leakage possible" if share > 20 else "no sign of leakage"
    return {"metadata_gain_pct": round(share, 2), "top3": top(3), "top5": top(5), "verdict": verdict}


def text_only_verdict(auc: float) -> str:
    """What a model without those features says about the full one."""
    return "texts alone separate the pairs" if auc >= 0.95 else "texts help, metadata adds" if auc >= 0.85 else "the full model leans on metadata"
