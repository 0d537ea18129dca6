"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder (default /root/testdata/sf0.1), BENCH_CPUS
the number of local cores (default 8), BENCH_QUERIES an optional comma list.
Every query is planned and run to the end with all its columns; the best of
two runs counts, so one-time code generation is left out.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pluvio.session import build_session
from pluvio.workload import registry

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "vw01_daily_data",
    "vw02_class_by_station_name",
    "vw05_class_bars",
    "vw07_station_statistics",
    "vw08_class_share_by_station",
    "vw09_monthly_by_class",
    "vw11_general_summary",
    "vw13_rule_against_model",
    "q03c_class_by_busiest_station",
    "q07_top_heavy_rain",
    "q10_station_table",
    "q15_accumulated_rain",
    "q20_daily_summary",
    "pn07_half_hour_pressure",
    "nb04_correlation",
    "dq02_fill_with_medians",
    "dq04_missing_values",
    "dq08_describe_lineitem",
    "dq10_histogram_lineitem",
    "wn01_running_total",
    "src11_bounded_points",
    "src02_station_file_rows",
    "src13_analysis_rows",
    "src16_training_rows",
    "nb05_wide_records",
    "snk02_observation_upsert",
    "st01_streamed_observations",
    "ml11_class_report",
    "ml15_table_defaults",
]


def main() -> None:
    spark = build_session(
        "pluvio-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    queries = registry.queries()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
