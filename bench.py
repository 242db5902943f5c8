"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional), BENCH_REPEAT (default 3; the best
run per query is reported, the first-run total is reported as well).
Each query is planned and fully executed into Spark's ``noop`` sink (every
row computed, nothing collected to the driver).  JVM start and an untimed
warm-up pass over the same queries on BENCH_WARMUP_DIR (default sf0.001;
"none" to skip) are excluded; plan building is included.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "features_50_w1",          # flagship: 50-column feature rows, 1-h windows
    "features_50_w24",
    "window_mean_pivot_w6",
    "score_parts_w12",
    "impute_as_written_w6",
    "cohort_filter",
    "interval_join_one_key",
    "interval_join_two_keys",
    "component_total",
    "dictionary_stats",
    "long_union",
    "vocab_topk",
    "encode",
    "pad",
    "clinical_features_w6",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from wardflow.plans import catalogue
    from wardflow.session import local_session

    names = [n for n in (os.environ.get("BENCH_QUERIES", "").split(",") if
                         os.environ.get("BENCH_QUERIES") else HEADLINE) if n in catalogue.QUERIES]
    spark = local_session(cpus, int(cpus))
    # Warm-up, untimed: every headline query once on the smallest data set
    # (JVM JIT, Spark's generated-code cache, Python workers), as a
    # long-running cluster session would be.  Timed runs follow at sf_dir.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and warm_dir != "none":
        for n in names:
            try:
                catalogue.QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - the timed run reports it
                pass

    times: dict[str, float | None] = {}
    first: dict[str, float] = {}
    for n in names:
        best = None
        try:
            for i in range(repeat):
                t0 = time.perf_counter()
                df = catalogue.QUERIES[n](spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
                if i == 0:
                    first[n] = dt
        except Exception as e:  # noqa: BLE001 - report and keep the other timings
            print(f"bench: {n} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            best = None
        times[n] = None if best is None else round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    ok = [v for v in times.values() if v is not None]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(ok), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "first_run_total": round(sum(first.values()), 3), "repeat": repeat,
                      "failed": [n for n, v in times.items() if v is None],
                      "warmup": os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")}))
    spark.stop()


if __name__ == "__main__":
    main()
