"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyforge.session import build_session, scratch
from tallyforge.workload import load_queries

HEADLINE = (
    "prj17_dedup", "prj18_dedup_ignoring_case", "jn08_star", "jn10_aggregate_before_join", "ag02_grouped",
    "ag14_calendar_rollup", "ag22_word_count", "wn01_top_per_group", "wn02_percent_rank", "wn10_ordered_batches",
    "ud04_anomaly", "ud12_rfm", "ud14_text_features", "mu03_merge", "dq08_report", "pl02_lifetime_value",
    "pl04_cohort_retention", "pl07_customer_360", "pl10_executive_report", "pl12_station_connections",
    "pl17_sentiment_by_mention", "sm03_hourly_windows",
    "pl08_shared_base", "pl22b_top_lists", "mu09_compact", "sm12_upsert", "sm15_replay", "ml03_text_classifier",
)


def run(spark, folder: str, name: str) -> float:
    """Seconds to build the query and write its rows to nowhere."""
    started = time.perf_counter()
    with scratch(spark):
        load_queries()[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session("bench", cores=cores)
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in HEADLINE:
        run(spark, folder, name)  # warm up the JVM and the file cache
        times[name] = round(run(spark, folder, name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
