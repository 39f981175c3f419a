import pytest
from pyspark.errors import PySparkException

from kinlink.operators import ground_truth as g
from kinlink.operators import recall as r
from tests.helpers import CANDIDATES, NORMALIZED, TRUTH, entity, one, rows


def _records(spark, *more):
    return g.truth_records(spark.createDataFrame([("S1-1", "S2-1, S2-2, S3-5"), ("S1-2", ""), ("S1-3", "S2-9"), *more], TRUTH))


def _cands(spark, *pairs):
    return spark.createDataFrame([(a, b, 0.5, m) for a, b, m in pairs], CANDIDATES)


def test_truth_parsing(spark):
    recs = {x["s1_id"]: x for x in _records(spark, ("S1-4", "nan"), ("S1-5", " NaN "), ("S1-6", "X-1"), ("S1-7", None), ("S1-1", "S2-2,S2-3")).collect()}
    assert recs["S1-1"]["s2_targets"] == ["S2-1", "S2-2", "S2-3"] and recs["S1-1"]["s3_targets"] == ["S3-5"]
    assert all(recs[i]["is_singleton"] for i in ("S1-2", "S1-4", "S1-5", "S1-7"))
    assert not recs["S1-6"]["is_singleton"] and recs["S1-6"]["s2_targets"] == []
    assert len(rows(g.targets(_records(spark)))) == 4


def test_padded_headers(spark):
    df = spark.createDataFrame([("S1-1", "S2-1")], "` source1_entity_id` string, `matched_entity_ids ` string")
    assert one(g.truth_records(df))["targets"] == ["S2-1"]


def test_unknown_prefix_is_an_error_if_strict(spark):
    df = spark.createDataFrame([("Q-1",)], "id string")
    with pytest.raises(PySparkException):
        df.select(g.source_of(df.id, strict=True)).collect()
    assert df.select(g.source_of(df.id)).collect()[0][0] is None


def test_pair_recall(spark):
    truth = spark.createDataFrame([("A", "B")], "entity_id_1 string, entity_id_2 string")
    got = one(r.pair_recall(_cands(spark, ("B", "A", "x"), ("A", "C", "x"), ("A", "D", "x")), truth))
    assert got["recall"] == 1.0 and abs(got["precision"] - 1 / 3) < 1e-12 and got["avg_candidates_per_entity"] == 1.5
    none = one(r.pair_recall(spark.createDataFrame([], CANDIDATES), truth))
    assert (none["recall"], none["precision"], none["missing_pairs"], none["avg_candidates_per_entity"]) == (0.0, 0.0, 1, 0.0)
    assert rows(r.missing_pairs(_cands(spark, ("A", "C", "x")), truth)) == [("A", "B")]


def test_coverage_is_by_substring(spark):
    truth = spark.createDataFrame([("A", "B"), ("A", "C")], "entity_id_1 string, entity_id_2 string")
    got = {x[0]: x[1:] for x in rows(r.coverage_by_method(_cands(spark, ("A", "B", "tfidf_name"), ("A", "D", "tfidf+token_sort")), truth))}
    assert got["tfidf"] == (2, 1, 50.0, 100.0) and got["tfidf_name"] == (1, 1, 50.0, 100.0) and got["token_sort"] == (1, 0, 0.0, 0.0)


def test_evaluate(spark):
    cands = _cands(spark, ("S1-1", "S2-1", "m"), ("S1-1", "S2-1", "n"), ("S1-1", "S2-7", "m"), ("S1-2", "S2-3", "m"))
    got = one(r.evaluate_candidates(_records(spark), cands, "S1_S2"))
    assert (got["s1_entities_in_gt"], got["total_gt_targets"], got["found_targets"]) == (2, 3, 1)
    assert (got["singleton_s1_count"], got["singleton_cand_vol"], got["total_candidates"], got["avg_candidates_per_entity"]) == (1, 1, 3, 1.5)
    none = one(r.evaluate_candidates(_records(spark), spark.createDataFrame([], CANDIDATES), "S1_S3"))
    assert (none["recall"], none["total_candidates"], none["avg_candidates_per_entity"]) == (0.0, 0, 0.0)
    assert rows(r.missing_targets(_records(spark), cands, "S1_S2")) == [("S1-1", "S2-2"), ("S1-3", "S2-9")]
    assert [x[:2] for x in rows(r.method_breakdown(_records(spark), cands, "S1_S2"))] == [("m", 1), ("n", 1)]


def test_subsets(spark):
    s1 = spark.createDataFrame([entity("S1-1", "a", None, "US"), entity("S1-3", "b", "1 x", None)], NORMALIZED)
    cands = _cands(spark, ("S1-1", "S2-1", "m"))
    assert one(r.address_missing_recall(_records(spark), cands, s1, "S1_S2")) == {"n_entities": 1, "total_gt_targets": 2, "found_targets": 1, "recall": 0.5}
    assert one(r.address_missing_recall(_records(spark), cands, s1.where("false"), "S1_S2"))["recall"] is None
    assert rows(r.recall_by_country(_records(spark), cands, s1, "S1_S2")) == [("US", 1, 2, 1, 0.5), ("unknown", 1, 1, 0, 0.0)]
    assert [x[0] for x in rows(r.recall_by_country(_records(spark), cands, s1.drop("country"), "S1_S2"))] == ["unknown"]
