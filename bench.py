"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) set the
input and the cores. Every query is warmed up once; the figure is the median of three runs
(one run for model fits).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cartflow.catalog import QUERIES
from cartflow.session import build_session

TIMED = {
    "d3_brand_top_sellers": 3, "d6_daily_unique_visitors": 3, "d10_dedup_five_columns": 3,
    "d16_drop_useless_columns": 3, "e4_session_journey": 3, "p10_training_table": 3,
    "p10_training_table_join_form": 3, "b19_b20_identity_split": 3, "p1_index_by_frequency": 3,
    "t1_exact_sample_per_class": 3, "t5_contiguous_folds": 3, "v2_area_under_roc": 3,
    "w1_counter_rate": 3, "w5_exact_quantiles": 3, "s6_session_counts": 3, "s7_throughput_tumbling": 3,
    "m1_logistic_regression": 1, "m2_gradient_boosted_trees": 1, "m4_random_forest": 1,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name, runs in TIMED.items():
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": events, "events_per_sec": {k: round(events / v) for k, v in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
