import random

from kinlink.config import BlockingConfig
from kinlink.operators import blocking as b
from tests.helpers import CANDIDATES, NORMALIZED, entity, rows


def _tables(spark):
    left = spark.createDataFrame([entity("S1-1", "acme widgets", "12 main street"), entity("S1-2", "zeta labs", None), entity("S1-3", None)], NORMALIZED)
    right = spark.createDataFrame([entity("S2-1", "acme widget", "12 main road"), entity("S2-2", "zeta laboratories", "9 oak lane", None), entity("S2-3", "unrelated thing", "12 main street", "FR")], NORMALIZED)
    return left, right


def test_tfidf_both_forms_agree(spark):
    left, right = _tables(spark)
    for k in (1, 2, 5):
        index = rows(b.tfidf_candidates(left, right, k))
        assert index == rows(b.tfidf_candidates(left, right, k, index_weights=0)) == rows(b.tfidf_candidates(left, right, k, index_weights=0, cell_weights=7))
        assert all(0.05 <= r[2] <= 1.000000001 for r in index)
    best = {r[0]: r[1] for r in rows(b.tfidf_candidates(left, right, 1))}
    assert best == {"S1-1": "S2-1", "S1-2": "S2-2"}


def test_self_pair_uses_a_place(spark):
    left, _ = _tables(spark)
    assert rows(b.tfidf_candidates(left, left, 1)) == []


def test_empty_sides(spark):
    left, right = _tables(spark)
    none = spark.createDataFrame([], NORMALIZED)
    for f in (lambda x, y: b.tfidf_candidates(x, y, 3), b.token_sort_candidates, b.address_prefix_candidates, b.rare_token_candidates, b.postal_ngram_candidates, b.country_tfidf_candidates):
        assert f(none, right).count() == 0 and f(left, none).count() == 0


def test_prefixes(spark):
    left, right = _tables(spark)
    assert rows(b.token_sort_candidates(left, right)) == [("S1-1", "S2-1", 1.0, "token_sort")]
    assert [r[:2] for r in rows(b.address_prefix_candidates(left, right))] == [("S1-1", "S2-1"), ("S1-1", "S2-3")]
    assert b.address_prefix_candidates(left.drop("address_missing"), right).count() == 0
    assert [r[:2] for r in rows(b.token_sort_candidates(left, left.union(right)))] == [("S1-1", "S2-1")]


def test_rare_tokens(spark):
    left = spark.createDataFrame([entity("L1", "common alpha beta"), entity("L2", "common")], NORMALIZED)
    right = spark.createDataFrame([entity("R1", "common alpha"), entity("R2", "common gamma"), entity("R3", "common beta alpha")], NORMALIZED)
    got = rows(b.rare_token_candidates(left, right, 0.4))
    assert got == [("L1", "R3", 1.0, "rare_token")]  # alpha is in two right rows of three, beta in one
    got = rows(b.rare_token_candidates(left, right, 0.7))
    assert got == [("L1", "R1", 0.5, "rare_token"), ("L1", "R3", 1.0, "rare_token")]
    assert [r[:2] for r in rows(b.rare_token_candidates(left, right, 0.7, max_per_entity=1))] == [("L1", "R3")]


def test_country_scope(spark):
    left, right = _tables(spark)
    got = rows(b.country_tfidf_candidates(left, right, 5, min_similarity=0.3))
    assert {r[:2] for r in got} == {("S1-1", "S2-1")}
    plain = b.country_tfidf_candidates(left.drop("country"), right.drop("country"), 1)
    assert {r[:2] for r in rows(plain)} == {("S1-1", "S2-1"), ("S1-2", "S2-2")}


def test_postal_grams_need_digits_and_an_address(spark):
    left, right = _tables(spark)
    assert {r[:2] for r in rows(b.postal_ngram_candidates(left, right, 5))} == {("S1-1", "S2-1"), ("S1-1", "S2-3")}


def test_merge(spark):
    a = spark.createDataFrame([("A", "B", 0.5, "tfidf"), ("B", "A", 0.9, "token_sort"), ("A", "C", 0.9, "tfidf")], CANDIDATES)
    assert rows(b.merge_candidates([a], canonical=True)) == [("A", "B", 0.9, "tfidf+token_sort"), ("A", "C", 0.9, "tfidf")]
    assert len(rows(b.merge_candidates([a]))) == 3
    assert rows(b.merge_candidates([a], 1, canonical=True)) == [("A", "B", 0.9, "tfidf+token_sort")]  # a tie goes to the smaller id
    assert [r[2] for r in rows(b.boosted(a))] == [1.0, 1.0, 1.0]


def test_grid_of_many_cells(spark):
    """Names of few words, so with many ties and common grams."""
    rng = random.Random(2)
    names = lambda side, n: spark.createDataFrame([entity(f"{side}-{i:03}", " ".join(rng.choice(("alpha", "alpine", "beta", "betamax", "gamma")) for _ in range(2)), country=rng.choice(("DE", "FR", None))) for i in range(n)], NORMALIZED)
    left, right = names("L", 40), names("R", 70)
    for f in (b.tfidf_scored, lambda *a, **k: b.tfidf_scored(*a, group_col="country", **k)):
        want = rows(f(left, right, 4))
        assert len(want) == 160 and rows(f(left, right, 4, index_weights=0, cell_weights=300)) == want


def test_pairs_beyond_the_cap_are_not_made(spark):
    rng = random.Random(3)
    side = lambda s, n: spark.createDataFrame([entity(f"{s}-{i:03}", f"acme {rng.choice('ab')} {i % 7}", "12 main street") for i in range(n)], NORMALIZED)
    left, right = side("S1", 30), side("S2", 90)
    assert b.address_prefix_candidates(left, right).count() == 30 * 90 and b.address_prefix_candidates(left, right, most=5).count() == 30 * 6
    cut = lambda most: rows(b.merge_candidates([b.token_sort_candidates(left, right, most=most), b.address_prefix_candidates(left, right, most=most), b.tfidf_candidates(left, right, 3)], 5))
    assert cut(5) == cut(None)
    same = b.merge_candidates([b.token_sort_candidates(right, right), b.address_prefix_candidates(right, right), b.tfidf_candidates(right, right, 3)], 5, canonical=True)
    assert rows(b.block_pair(right, right, BlockingConfig(tfidf_top_k=3, max_candidates_per_entity=5))) == rows(same)


def test_cap_and_composition(spark):
    many = spark.createDataFrame([("A", f"R{i:03}", i / 200, "tfidf") for i in range(200)], CANDIDATES)
    kept = rows(b.merge_candidates([many], 100))
    assert len(kept) == 100 and min(r[2] for r in kept) == 0.5
    left, right = _tables(spark)
    both = b.block_pair(left, right, BlockingConfig(tfidf_top_k=2))
    assert {r[3] for r in rows(both)} >= {"addr_prefix+tfidf+token_sort"}
    assert sum(r[1] for r in rows(b.method_counts(both))) == both.count()


def test_config_names():
    c = BlockingConfig.from_mapping({"ngram_size": 4, "tfidf_top_k": 7, "other": 1})
    assert (c.ngram_max, c.tfidf_top_k, c.max_candidates_per_entity) == (4, 7, 100)
