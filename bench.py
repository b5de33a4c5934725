"""Time the headline queries: one warm-up and one timed run each, full results computed.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import plans  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "session_summary",
    "sessionize",
    "dedup_events",
    "lifecycle_sessions",
    "attach_identity",
    "consent_gate",
    "fold_super_properties",
    "enrich_events",
    "scrub_pii",
    "sanitize_properties",
    "sanitize_free_json",
    "extract_attribution",
    "pack_event_batches",
    "read_event_batches",
    "flatten_entitlement_responses",
    "is_entitled",
    "is_entitled_as_of",
    "reconcile_purchases",
    "resolve_replays",
    "delivery_outcomes",
    "coalesce_screens",
    "attach_breadcrumbs",
    "error_groups",
    "frame_jank",
    "session_funnel",
    "active_users",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, partitions, **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in only:
        for _ in range(2):
            start = time.perf_counter()
            plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
