from kinlink.operators import experiments as x
from kinlink.operators import ground_truth
from tests.helpers import NORMALIZED, TRUTH, entity


def test_all_runs(spark):
    left = spark.createDataFrame([entity("S1-1", "acme widgets", "12 main street"), entity("S1-2", "zeta labs", None)], NORMALIZED)
    right = spark.createDataFrame([entity("S2-1", "acme widget", "12 main road"), entity("S2-2", "zeta laboratory", "9 oak lane")], NORMALIZED)
    recs = ground_truth.truth_records(spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2")], TRUTH))
    runs = x.all_experiments()
    assert len(runs) == 21 and len({r.name for r in runs}) == 21
    tables = x.strategy_tables(left, right, sorted({p for r in runs for p in r.parts}))
    pairs = x.run_candidates(runs, tables)
    got = {r["experiment"]: r for r in x.evaluate_runs(runs, pairs, recs, left, "S1_S2").collect()}
    assert len(got) == 21 and all(0 <= r["recall"] <= 1 for r in got.values())
    assert [got[f"exp1a_tfidf_topk_{k}"]["recall"] for k in x.TOP_KS] == sorted(got[f"exp1a_tfidf_topk_{k}"]["recall"] for k in x.TOP_KS)
    assert got["exp2b_all3"]["recall"] >= got["exp2b_name_only"]["recall"] and got["exp2a_union_baseline"]["recall"] == 1.0
    assert got["exp1a_tfidf_topk_50"]["address_missing_recall"] == 1.0
    one_type = x.evaluate_runs(runs, pairs, recs, left, "S1_S2")
    table = {r["experiment"]: r for r in x.tradeoff_table(one_type, one_type).collect()}
    assert table["exp2a_union_baseline"]["recommendation"] == table["exp2a_weighted_tfidf_priority"]["recommendation"] == "keep"
    assert x.country_breakdown(pairs, recs, left, "S1_S2").where("experiment = 'exp2b_all3'").collect()[0]["total_gt_targets"] == 2
