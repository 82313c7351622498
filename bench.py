"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkloom import bindings
from linkloom.session import local_session

HEADLINE = (
    "fact_consolidate", "topx_classes", "update_join_basic", "upsert_last_wins", "per_doc_counts", "concat_values",
    "clean_names", "clean_markup", "fold_ascii", "clean_places", "segment_split", "date_normalise", "similar_words",
    "graph_edges", "degree", "components", "component_rank", "clustering_coefficient", "burt_constraint", "pagerank",
    "person_fuzzy_ids", "word_frequency", "org_features", "place_table", "geocode_cascade", "truth_match",
    "truth_summary", "shred_inventor", "multi_doc_split", "claims_extract", "csv_infer", "stream_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    queries = bindings.queries()
    # start the session's workers and code paths before timing
    queries["value_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
