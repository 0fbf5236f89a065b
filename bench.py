"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from graphprep.plans.catalog import QUERIES
from graphprep.workspace import local_session

HEADLINE = [
    "parse_triples",
    "min_count_filter",
    "split_hash",
    "entity_dictionary",
    "encode_triples",
    "bucket_counts",
    "entity_names",
    "label_entity_names",
    "word_search",
    "search_page",
    "entity_substring_search",
    "knn_partitioned",
    "knn_single_index",
    "score_triples",
    "negative_samples",
    "rank_eval",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    seconds, rows = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        result = QUERIES[name](spark, sf_dir)
        # Every column is made; a count would let the optimizer leave out what the query is timed for.
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        rows[name] = result.count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
