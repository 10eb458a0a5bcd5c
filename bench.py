"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.  Every query is
built and run to its last row; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quarterdeck.plans.queries import QUERIES
from quarterdeck.session import build_session

HEADLINE = (
    "staged_sales",
    "revenue_facts",
    "segment_performance",
    "grand_totals",
    "top_products",
    "monthly_trend",
    "segment_regions",
    "quality_checks",
    "id_differences",
    "latest_deals",
    "activity_signals",
    "deal_sentiment",
    "tone_scores",
    "pii_redaction",
    "topic_screen",
    "corpus_chunks",
    "nearest_chunks",
    "deal_health",
    "segment_growth",
    "benchmark_gaps",
    "opportunity_summary",
    "competitor_ranking",
    "booking_allocation",
    "search_snippets",
    "benchmark_answers",
    "action_answers",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
