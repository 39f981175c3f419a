"""Lists and settings that queries and their SQL twins share, against literals, so that a wrong one can't pass on both sides."""

from kinlink.config import BlockingConfig, NegativeSamplingConfig
from kinlink.functions import text
from kinlink.operators import evaluate, experiments
from kinlink.operators.features import FEATURES, METADATA, RATIOS
from kinlink.plans import fixtures, sql


def _map(pairs):
    return " ".join(f"{a}={b}" for a, b in pairs)


def test_word_lists():
    assert " ".join(text.LEGAL_FORMS) == (
        "incorporated corporation associates unlimited solutions holdings services partners group limited company corp inc ltd llc llp lllp lp plc pllc pc co gmbh ag sa sas bv nv pty pvt srl aps oy ab as"
    )
    assert _map(text.NAME_ABBREVIATIONS) == (
        "intl=international nat'?l=national mfg=manufacturing mgmt=management svcs=services svc=service tech=technology dev=development prod=products pubs=publications pub=publication dist=distribution corp=corporation"
    )
    assert _map(text.ADDRESS_ABBREVIATIONS) == (
        "st=street ave=avenue av=avenue blvd=boulevard rd=road dr=drive ln=lane ct=court ctr=center pl=place sq=square hwy=highway fwy=freeway pkwy=parkway expy=expressway brg=bridge trk=track trce=trace"
        " ste=suite apt=apartment fl=floor flr=floor bldg=building rm=room dept=department n=north s=south e=east w=west ne=northeast nw=northwest se=southeast sw=southwest"
    )


def test_features():
    assert " ".join(FEATURES) == (
        "name_exact name_levenshtein name_jaro_winkler name_token_jaccard name_token_sort_ratio name_ngram_cosine name_length_difference"
        " address_exact address_jaccard address_ngram_similarity address_edit_distance numeric_token_similarity postal_similarity address_length_difference"
        " country_exact country_normalized country_unseen"
        " blocking_score blocking_method_tfidf blocking_method_token_sort blocking_method_addr_prefix candidate_rank candidate_margin"
        " candidate_source_s2 candidate_source_s3 address_missing_left address_missing_right address_missing_either"
    )
    assert METADATA == ["blocking_score", "candidate_rank", "candidate_margin"] and RATIOS == ["name_jaro_winkler", "name_token_sort_ratio"]


def test_settings():
    b, n = BlockingConfig(), NegativeSamplingConfig()
    assert (b.tfidf_top_k, b.ngram_min, b.ngram_max, b.min_similarity, b.token_sort_prefix_len, b.address_prefix_len, b.max_candidates_per_entity) == (50, 2, 3, 0.05, 5, 8, 100)
    assert (n.hard_per_positive, n.easy_per_positive, n.hard_delta, n.easy_percentile, n.seed) == (2, 2, 0.1, 0.3, 42)
    assert experiments.TOP_KS == (10, 25, 50, 100) and experiments.RARITIES == (0.001, 0.005, 0.01) and experiments.CAPS == (50, 100, 200)
    assert evaluate.THRESHOLDS == (0.5, 0.6, 0.7, 0.8, 0.9, 0.95) and evaluate.BETA == 0.5
    assert (sql.TOP_K, sql.CAP, sql.MIN_SIM, sql.LARGEST_K) == (10, 100, 0.05, 200) == (fixtures.TOP_K, fixtures.CAP, fixtures.MIN_SIM, max(experiments.CAPS))


def test_experiments():
    names = [e.name for e in experiments.all_experiments()]
    assert " ".join(names) == (
        "exp1a_tfidf_topk_10 exp1a_tfidf_topk_25 exp1a_tfidf_topk_50 exp1a_tfidf_topk_100 exp1b_rare_token_0.001 exp1b_rare_token_0.005 exp1b_rare_token_0.01"
        " exp1c_global_cap_50 exp1c_global_cap_100 exp1c_global_cap_200 exp2a_union_baseline exp2a_weighted_tfidf_priority"
        " exp2b_all3 exp2b_drop_token_sort exp2b_drop_address exp2b_drop_tfidf exp2b_name_only"
        " exp3a_postal_char_ngram exp3b_country_tfidf_name exp3b_country_tfidf_addr exp3c_addr_missing_name_only_quality"
    )
