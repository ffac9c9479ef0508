"""Headline timings: prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3; the median is reported).
Every query runs to completion through the no-op sink (all rows produced, nothing collected).
The four activity layouts are written once before timing (setup, not timed).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import load_all  # noqa: E402
from tidemark.plans.layouts import four_layouts  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "j01_top_clients",
    "u04_dau_wau_mau",
    "u07_retention",
    "u11_peak_hours",
    "u01_user_profile_layouts",
    "u02_hour_activity_layouts",
    "u03_range_activity_layouts",
    "w02_claim_batch",
    "i01_settle",
    "i03_confirm_orders",
    "i05_live_carts",
]
# Added later; not part of "value", which stays comparable with round 1, but of "value_all".
MORE = ["i11_availability", "w01_claim_calls", "s09_replace_partition"]
ONCE = ["z03_stream_carts", "z05_stream_settle"]  # whole streams: one run, no warm-up


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="tidemark-bench")
    queries, _ = load_all()
    four_layouts(spark, sf_dir)  # setup: write the layouts once

    timings = {}
    for name in HEADLINE + MORE + ONCE:
        fn = queries[name]
        samples = []
        for i in range(1 if name in ONCE else runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0 or name in ONCE:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)

    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings[n] for n in HEADLINE), 3),
        "value_all": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
