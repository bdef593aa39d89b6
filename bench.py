"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line {"metric", "value", "unit", "queries", "sf"}.

Each query is executed in full with a ``noop`` write (every row produced, none
collected).  Times include planning, so eager sub-steps (model fits,
materialised lineage cuts) are counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["prestige", "prestige_oof", "stratified_folds", "impute_bucket_median",
            "derived_features", "dedup_key", "rating_stats", "enrich_left", "band_join",
            "prior_count", "title_join", "nested_role_extract", "mann_whitney",
            "mi_permutation", "mi_knn", "screen_candidates", "partial_spearman", "spearman_matrix",
            "cov_matrix", "tfidf_top_terms", "tfidf_wide", "threshold_sweep", "cv_summary",
            "redundancy_prune", "rf_predict", "pca_components", "ordered_scores",
            "pagerank_bipartite", "nmf_loss", "stack_scores"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tabsieve.plans import catalog
    from tabsieve.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus), driver_memory="16g")
    qs = catalog.queries()
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q in qs]
    # warm-up: JVM, Python workers, parquet footers
    qs["null_profile"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
