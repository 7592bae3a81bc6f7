"""Times the registered queries once warm; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names; default: the headline list below), BENCH_RUNS (timed runs, median is kept).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from corpuslab.plans.registry import ALL
from corpuslab.session import build_session

HEADLINE = """
clean_comments prepare_text txt_to_comments thread_flatten comments_array missing_comments ttl_lookup cooldown_windows
containment_match per_file_sample global_index enrich_by_id enrich_priority hash_embed embed_documents embedding_norms
sanity_checks dimension_stats norm_histogram sample_describe dedup_embeddings verify_dedup centroids cluster_extremes
cluster_results assign_nearest_centroid kmeans_lloyd silhouette_cosine elbow_select kmeans_fit
""".split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if names == ["all"]:
        names = list(ALL)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        function = ALL[name][0]
        taken = []
        for _ in range(1 + runs):  # the first run warms up
            start = time.perf_counter()
            function(spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {taken[0]:.2f} {times[name]:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
