"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full plan, no
driver collection) after one global warm-up, $BENCH_REPEAT times (default 2);
the per-query figure is the fastest run, the first run's figure is reported
too. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from docket.plans import all_queries
    from docket.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="docket-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="docket-bench-")})
    qs = all_queries()
    names = only or sorted(qs)
    # warm-up: JIT, class loading, file listing cache
    qs["latest_per_key"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for n in names:
        runs = []
        for _ in range(repeat):
            t0 = time.time()
            qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.time() - t0, 3))
        times[n], first[n] = min(runs), runs[0]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "n_queries": len(times),
                      "timing": f"min of {repeat} runs per query after one warm-up",
                      "first_run_total": round(sum(first.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
