"""Time the headline queries and print one JSON line.

Every query runs from the raw versions to its answer: newest-version choice, staging,
marts, question.  ``marts/...`` entries repeat the questions on stored marts, and
``build_marts`` is the time to write those.  Each figure is the median of BENCH_RUNS runs
after one warm-up; results are fully computed (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from storelake.plans.questions import QUESTIONS
from storelake.registry import registered, shown, star_warehouse
from storelake.session import local_session, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

RAW_QUERIES = [
    "latest_version",
    "fact_sales",
    "int_sales_enriched",
    "fact_inventory_movement",
    *QUESTIONS,
    "incremental_extract",
    "header_total_rollup",
    "dq_not_null",
    "dq_gate",
    "pivot_store_month",
    "incremental_merge",
    "current_over_base",
    "stream_latest_version",
    "refresh_fact_sales",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_of(action) -> float:
    action()
    return round(statistics.median(timed(action) for _ in range(RUNS)), 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, "bench")
    catalog = registered()
    seconds: dict[str, float] = {}
    for name in RAW_QUERIES:
        seconds[name] = median_of(lambda: drain(catalog[name](spark, SF_DIR)))

    marts = star_warehouse(spark, SF_DIR)
    seconds["build_marts"] = round(
        timed(lambda: marts.materialize(scratch_path(spark, "bench-marts"))), 3
    )
    for name, question in QUESTIONS.items():
        seconds[f"marts/{name}"] = median_of(lambda: drain(shown(question(marts))))

    print(
        json.dumps(
            {
                "metric": "total seconds, all queries (median of warm runs)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cores": CPUS,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
