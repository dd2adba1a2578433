"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

All queries run once cold, then five rounds of all follow; a query's figure is the median of
its rounds. Results are fully computed and dropped (the 'noop' sink), so no driver-side
conversion is timed. The time to build and plan a query counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import QUERIES
from ledgerloom.session import local_session

HEADLINE = [
    "expense_matrix",
    "revenue_matrix",
    "surplus_table",
    "keyed_surplus",
    "report_bundle",
    "report_documents",
    "money_format",
    "money_parse",
]
WARM_ROUNDS = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(
        cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, **{"spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(1 + WARM_ROUNDS):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - start)
    cold = {name: round(runs[0], 3) for name, runs in times.items()}
    warm = {name: round(statistics.median(runs[1:]), 3) for name, runs in times.items()}
    print(json.dumps({
        "metric": "sum of warm medians of the headline queries",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
