"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Every query runs to the end
through the noop sink, twice; the better time counts, so that start-up cost of the JVM does not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "corpus_profile_by_source", "clean_corpus", "dedup_first_wins", "shard_assign", "char_budget",
    "sample_per_group", "length_profile_chars", "pretoken_counts", "bpe_merges", "encode_rows",
    "decode_round_trip", "training_rows", "packing_profile", "bpb_ratio", "running_best", "top_hits",
    "summary", "population_replay", "annealing_replay", "smoothed_loss", "step_telemetry",
)
# Trained once per session, so a second run would time nothing.
ONCE = {"bpe_merges"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from sheafmill.session import local_session

    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    from sheafmill.catalog import QUERIES

    times = {}
    for name in names:
        best = None
        for _ in range(1 if name in ONCE else 2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
