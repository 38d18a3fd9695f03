"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.  Each query
is run to the end on a sink that discards rows, the best of the timed runs
after one warm-up run of the first query is reported.
"""

from __future__ import annotations

import json
import os
import time

from tableward import session
from tableward.registry import registered

HEADLINE = (
    "column_profile_lineitem", "quality_report", "quality_scores", "duplicate_count", "dedupe", "dedupe_text",
    "full_clean", "outliers_sequential", "impute_median", "ffill", "clean_text", "coerce_datetime", "coerce_numeric",
    "ingest_normalise", "describe", "corr_matrix", "histogram", "box_stats", "violin_box", "pivot_mean",
    "value_counts_top", "linear_trend", "incremental_files", "stage_status", "line_numbers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session.build(
        "bench", master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registered()

    def run(name: str) -> float:
        begun = time.perf_counter()
        known[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    run(HEADLINE[0])
    seconds = {name: round(min(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    session.release(spark)
    result = {
        "metric": "total_seconds_headline_queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
