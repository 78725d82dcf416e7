"""Time the headline queries; print one JSON line.

Each query is built and run to a no-op sink once, after one small warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patina.session import local_session  # noqa: E402
from queries import QUERIES  # noqa: E402

HEADLINE = [
    "profile_types_nulls",
    "profile_numeric",
    "pattern_counts",
    "top_values",
    "top_texts",
    "record_repetition",
    "order_profile",
    "order_profile_by_key",
    "record_index",
    "stride_sample",
    "corruption_plan",
    "apply_patches",
    "detect_changes",
    "manifest_evidence",
    "novelty",
    "row_overlap",
    "identifier_overlap",
    "field_constraints",
    "machine_rules",
    "donor_blend",
    "conditional_support",
    "trip_audit",
    "header_rows",
    "leaf_cells",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["head"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "spark": spark.version,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
