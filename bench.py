"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (timed runs after one warm-up, default 2).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "product_documents", "entity_rows", "objects_to_index", "index_chunks", "bulk_outcome", "status_upsert", "index_progress", "category_documents",
    "category_paths", "product_sales", "product_prices", "cms_documents", "save_metas", "facet_counts", "facet_or", "term_postings", "multi_match",
    "fuzzy_match", "autocomplete_topk", "tokens_edge_ngram", "tokens_stem_stop", "change_feed_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    from shelfweave import build_session
    from shelfweave.plans import catalogue

    spark = build_session(f"local[{cpus}]", cpus, **{"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for attempt in range(runs + 1):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt or not runs:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus}))


if __name__ == "__main__":
    main()
