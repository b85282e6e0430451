"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8) and ``BENCH_QUERIES``
(comma list) select what is run.  Every query is executed in full (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fingerprint_dedup", "url_dedup", "dedup_both", "role_filter", "extract_tools", "firm_match_fuzzy",
    "firm_match_fuzzy_suppliers", "firm_gate", "salary_estimate", "structured_location", "slug_uniquify",
    "match_published", "html_text_variants", "extract_links", "feed_greenhouse", "feed_zoho", "feed_icims",
    "merge_firms", "facet_counts", "board_quality", "discover_sources", "role_counts", "enrich_listings",
    "daily_run_funnel",
]


def main() -> None:
    from checks.queries import QUERIES
    from hirestream.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"), "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the executor threads and the Python workers before the clock
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
             "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
