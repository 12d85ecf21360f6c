"""Benchmark: runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and prints one JSON line with per-query seconds.

Each query is materialised with a full write to a no-op sink
(``format('noop')``) so every row and column is computed, nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "video_analysis", "entity_analysis", "topic_analysis", "topics_by_channel",
    "emotions_over_time", "lookup_video_info", "collect_multi_entity_data",
    "missing_transcripts", "append_new_listing", "upsert_index", "assemble_text",
    "clean_text", "chunk_text", "cleaned_entities", "topic_list", "classify_emotion",
    "summarize", "latest_videos", "extract_entities", "overall_classification",
    "classify_transcripts", "build_entities_for_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from vigil.plans.registry import QUERIES
    from vigil.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "16")))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # warm-up: JVM start, Parquet footers
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    # each query runs twice: the first run pays JIT/codegen warm-up for
    # that plan shape (reported as "cold"), the second is the measurement
    cold, times = {}, {}
    for n in names:
        for store in (cold, times):
            t0 = time.time()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            store[n] = round(time.time() - t0, 3)
        print(f"{n}: cold {cold[n]}s warm {times[n]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "cold_total": round(sum(cold.values()), 3), "cold": cold,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
