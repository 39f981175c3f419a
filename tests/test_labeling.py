from kinlink.config import NegativeSamplingConfig
from kinlink.operators import ground_truth, labeling
from tests.helpers import CANDIDATES, TRUTH, one, rows


def _labeled(spark):
    pairs = [("S1-1", "S2-1", 0.9), *(("S1-1", f"S2-{i}", i / 100) for i in range(10, 90, 5)), ("S1-2", "S2-1", 0.3), ("S1-2", "S2-2", 0.2), ("S1-3", "S2-5", 0.4), ("S1-9", "S2-5", 0.4)]
    recs = ground_truth.truth_records(spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", ""), ("S1-3", "S2-77")], TRUTH))
    return labeling.assign_labels(spark.createDataFrame([(*p, "tfidf") for p in pairs], CANDIDATES), recs)


def test_labels(spark):
    got = {(x["source1_entity_id"], x["candidate_entity_id"]): (x["label"], x["negative_type"]) for x in _labeled(spark).collect()}
    assert got["S1-1", "S2-1"] == (1, "positive") and got["S1-2", "S2-1"] == (0, "singleton_negative")
    assert got["S1-9", "S2-5"] == (0, "unsampled_negative") and got["S1-3", "S2-5"] == (0, "unsampled_negative")


def test_sampling(spark):
    out = labeling.sample_negatives(_labeled(spark)).collect()
    by = {}
    for x in out:
        by.setdefault(x["negative_type"], []).append(x)
    assert {k: len(v) for k, v in by.items()} == {"positive": 1, "hard_negative": 2, "easy_negative": 2, "singleton_negative": 2}
    assert all(x["blocking_score"] >= 0.8 for x in by["hard_negative"]) and all(x["blocking_score"] <= 0.33 for x in by["easy_negative"])
    assert sorted(map(repr, out)) == sorted(map(repr, labeling.sample_negatives(_labeled(spark).repartition(7)).collect()))
    other = labeling.sample_negatives(_labeled(spark), NegativeSamplingConfig(seed=1)).collect()
    assert len(other) == len(out)


def test_wider_hard_pool_and_overlap(spark):
    pairs = [("S1-1", "S2-1", 0.9, "tfidf"), ("S1-1", "S2-2", 0.75, "tfidf")]
    recs = ground_truth.truth_records(spark.createDataFrame([("S1-1", "S2-1")], TRUTH))
    labeled = labeling.assign_labels(spark.createDataFrame(pairs, CANDIDATES), recs)
    assert sorted(x["negative_type"] for x in labeling.sample_negatives(labeled).collect()) == ["easy_negative", "hard_negative", "positive"]
    assert sorted(x["negative_type"] for x in labeling.sample_negatives(labeled, distinct=True).collect()) == ["hard_negative", "positive"]


def test_statistics(spark):
    s = one(labeling.label_statistics(labeling.sample_negatives(_labeled(spark)), "S1_S2"))
    assert (s["total_pairs"], s["positives"], s["negatives"], s["imbalance_ratio"], s["positive_rate_pct"]) == (7, 1, 6, 6.0, 14.29)
    none = one(labeling.label_statistics(_labeled(spark).where("false"), "x"))
    assert none["total_pairs"] == 0 and none["positive_rate_pct"] == 0.0


def test_stratified(spark):
    recs = ground_truth.truth_records(spark.createDataFrame([(f"S1-{i}", "S2-1" if i % 2 else "") for i in range(40)], TRUTH))
    got = labeling.stratified_entities(recs, 5, 3)
    assert sorted(x[1] for x in rows(got)) == [False] * 5 + [True] * 3
    assert rows(got) == rows(labeling.stratified_entities(recs.repartition(5), 5, 3))
