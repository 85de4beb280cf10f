"""Times the headline queries on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` cores and prints one JSON line.

Each query runs once to warm up and is then timed; all rows are computed and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from formtide.plans import checks  # noqa: E402
from formtide.session import local_session  # noqa: E402

HEADLINE = (
    "unpivot_outcomes",
    "daily_totals",
    "daily_map_totals",
    "rolling_winshare",
    "rolling_winshare_map",
    "rolling_winshare_map_mixed",
    "asof_lookup",
    "asof_lookup_composite",
    "training_set",
    "keyed_lookup",
    "published_predictions",
    "category_dictionary",
    "category_encode",
    "classification_report",
    "dataset_profile",
    "change_feed",
    "incremental_upsert",
)


def run(name: str, spark, folder: str) -> float:
    start = time.perf_counter()
    checks.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8, app="formtide-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(name, spark, folder)
        seconds[name] = round(run(name, spark, folder), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = Path(folder).name.removeprefix("sf")
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
