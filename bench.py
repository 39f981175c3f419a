"""Times the headline queries once each, cold, and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from kinlink.plans import fixtures
from kinlink.plans.registry import QUERIES
from kinlink.session import build_session

HEADLINE = (
    "profile_text_fields", "normalize_batch", "block_tfidf", "block_tfidf_join", "block_token_sort", "block_address_prefix", "block_rare_token", "block_postal_ngram", "block_country_tfidf_name",
    "merge_candidates", "recall_s1_s2", "coverage_by_method", "sample_negatives", "features_name", "features_address", "feature_stats", "metrics_by_source", "exp_tradeoff_table", "gbt_train_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("kinlink-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        fixtures.forget()
        spark.catalog.clearCache()
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
