"""Times the headline queries and prints one line of JSON. Each query is planned and run anew every time."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver.queries import QUERIES  # noqa: E402
from valuelens.session import build_session  # noqa: E402

HEADLINES = [
    "variant_samples_component",
    "variant_samples",
    "backfill_samples",
    "sample_records_flat",
    "component_views_hourly",
    "landing_views_daily",
    "acquisition_totals",
    "boost_views",
    "boost_acquisitions",
    "boost_candidates",
    "boost_entries",
    "boost_records",
    "samples_latest",
    "run_metrics",
    "no_views_check",
    "experiment_configs",
    "price_dimension",
    "fx_to_gbp",
    "stream_hourly_samples",
    "stream_article_windows",
]
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINES[:4]:
        run(name)  # warms the session itself, so that the order of queries does not count
    seconds = {}
    for name in HEADLINES:
        run(name)  # warm-up
        seconds[name] = round(statistics.median(run(name) for _ in range(REPEATS)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm median of 3 each",
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
