"""Recall of equal keys, counted without the pairs, equals that of the pairs."""

from pyspark.sql import functions as F

from kinlink.operators import blocking, ground_truth, recall
from tests.helpers import NORMALIZED, TRUTH, entity, one


def test_counts_of_keys_equal_counts_of_pairs(spark):
    names = ["north mill", "north hill", "stone", None, "stone river"]
    left = [entity(f"S1-{i}", names[i % 5]) for i in range(12)] + [entity("S2-3", "stone")]
    right = [entity(f"S2-{i}", names[i % 4]) for i in range(9)]
    truth = [(f"S1-{i}", ("S2-1,S2-2,S3-1", "", "S2-2,S2-6", "S3-4")[i % 4]) for i in range(12)] + [("S2-3", "S2-3,S2-2")]
    records = ground_truth.truth_records(spark.createDataFrame(truth, TRUTH))
    key = F.substring("token_sorted_name", 1, 5)
    for more in ([], [entity("S2-2", "north mill")]):  # the second: an id with two keys
        a, b = spark.createDataFrame(left, NORMALIZED), spark.createDataFrame(right + more, NORMALIZED)
        want = one(recall.evaluate_candidates(records, blocking.token_sort_candidates(a, b), "S1_S2"))
        assert want["found_targets"] > 0 and want["singleton_cand_vol"] > 0
        assert one(recall.evaluate_key_candidates(records, a, b, key, "S1_S2")) == want
