"""Times the output tables at one scale factor and prints one JSON line.

The stage is written once before the clock starts; every figure is the median of three runs after a warm-up,
each run reading the stored stage and writing all rows to the noop sink. A stored replacement and a load
of files are timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from harness import carrier  # noqa: E402
from harness.registry import BY_NAME  # noqa: E402

HEADLINE = (
    "response",
    "stud_attr_direct",
    "stud_attr_cleaned",
    "intern_direct",
    "intern_cleaned",
    "intl_exp_direct",
    "intl_exp_cleaned",
    "conn_to_psu_direct",
    "conn_to_psu_cleaned",
    "intern_lrned",
    "empl_job_lrned",
    "acadyear_labels",
    "replace_by_term",
    "join_company_by_shuffle",
    "missing_days_of_orders",
    "replace_by_term_stored",
    "csv_multiline_split",
)
# These deliver, load and store files themselves and run for long: one run each.
ONCE = HEADLINE[-2:]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = carrier.stage(spark, sf_dir).count()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(1 if name in ONCE else 1 + RUNS):
            start = time.perf_counter()
            BY_NAME[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
                "stage_rows": rows,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
