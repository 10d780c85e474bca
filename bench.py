"""Bench: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one
JSON line.  ``value`` is the total of the headline queries; ``queries`` has every query once.  Each query is fully executed (``noop`` sink: every row computed, nothing
collected); times include plan-time jobs (split histograms, checkpoints, counts)."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reelrec.plans.catalog import QUERIES  # noqa: E402
from reelrec.session import local_session  # noqa: E402

try:
    from reelrec.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402
except ImportError:
    LLM_QUERIES = {}

HEADLINE = [
    "popular_top_k",
    "ingest_ratings",
    "split_train",
    "split_test",
    "rank_within_rating",
    "rank_band_sample",
    "wire_decode",
    "route_new_users",
    "recommend_routed",
    "factor_top_k",
    "prediction_fact_join",
    "best_run",
    "recommend_all_users",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    every = {**QUERIES, **LLM_QUERIES}
    only = sys.argv[1:] or [*HEADLINE, *(n for n in every if n not in HEADLINE)]
    scratch = tempfile.mkdtemp(prefix="reelrec-bench-")
    extra = {"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")}
    if os.environ.get("BENCH_EVENT_LOG"):   # stage/task times without the UI: an event log file
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
                      "spark.eventLog.dir": os.path.join(scratch, "events")})
        print(f"event log: {os.path.join(scratch, 'events')}", file=sys.stderr)
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), "reelrec-bench", extra=extra)
    # warm-up, not timed: JVM code paths and file listing, and the Python worker pool that
    # the first mapInPandas stage would otherwise start inside a timed query
    QUERIES["rating_count"](spark, sf_dir).collect()
    spark.range(0, 64, 1, int(cpus) if cpus.isdigit() else 8).mapInPandas(lambda it: it, "id long").collect()
    times = {}
    for name in only:
        t0 = time.perf_counter()
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(t for n, t in times.items() if n in HEADLINE or sys.argv[1:]), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
