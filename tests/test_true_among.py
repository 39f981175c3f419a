"""Targets among pairs without a row for each target; a hot prefix meets no more than a merge's cap can keep."""

from kinlink.operators import blocking, ground_truth
from kinlink.plans import fixtures as fx
from kinlink.plans.registry import QUERIES
from tests.helpers import TRUTH, rows


def test_targets_among_pairs(spark):
    records = ground_truth.truth_records(spark.createDataFrame([("S1-1", "S2-1,S2-2,S3-5,X-1"), ("S1-2", ""), ("S1-3", "S2-9")], TRUTH))
    pairs = spark.createDataFrame([("S1-1", "S2-2"), ("S1-1", "S2-2"), ("S1-1", "S2-7"), ("S1-1", "X-1"), ("S1-2", "S2-1"), ("S1-3", "S2-9"), ("S1-4", "S2-1")], "a string, b string")
    assert rows(ground_truth.true_among(records, pairs, "a", "b")) == [("S1-1", "S2-2"), ("S1-3", "S2-9")]


def test_weighted_merge_makes_no_pairs_beyond_its_cap(spark, monkeypatch):
    asked = []
    for name in ("token_sort_candidates", "address_prefix_candidates"):
        monkeypatch.setattr(blocking, name, lambda *a, made=getattr(blocking, name), **b: (asked.append(b.get("most")), made(*a, **b))[1])
    QUERIES["merge_weighted"](spark, "/root/testdata/sf0.001")
    assert asked == [fx.CAP, fx.CAP]
