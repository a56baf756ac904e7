"""Wall time of the headline queries; prints one JSON line.

Every query is run twice from the files and the faster run is reported, because the first run of a plan mostly
measures code generation and a cold JVM. Nothing is kept between the runs.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans.queries import SQL_CHECKED
from tidemark.session import session

HEADLINE = (
    "items_per_order",
    "base_table",
    "rfm_features",
    "feature_matrix",
    "customer_targets",
    "spend_tiers",
    "chronological_split",
    "train_test_features",
    "time_series_folds",
    "binary_report",
    "tier_report",
    "validate_requests",
    "request_features",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    SQL_CHECKED["orders_valid_status"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            SQL_CHECKED[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
