"""Time the headline queries on a local master; one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads, BENCH_RUNS the runs per
query (the best one counts), BENCH_QUERIES a comma list, or `all`.
"""

import json
import os
import statistics
import sys
import time

from checks.compare import session
from checks.queries import queries
from editflow.session import configure

HEADLINE = """
parse_irc parse_json_edits decode_bus write_edits read_edits count_by_channel count_rollup inserted_total
weekly_minute_counts zero_fill moving_average running_count latest_n every_nth route_edits
attach_model_before fit_all_models detect_anomalies metric_gauge metric_timing metric_sketches dedupe_redelivery
find_edit compact_edits stream_counts stream_tallies stream_gauges stream_latest stream_numbered stream_once
stream_store stream_score
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries()) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = configure(session(cpus))
    spark.range(1000).selectExpr("sum(id)").collect()

    best, median = {}, {}
    for name in names:
        times = []
        for _ in range(runs):
            begun = time.perf_counter()
            queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        best[name] = round(min(times), 3)
        median[name] = round(statistics.median(times), 3)
        print(f"{name} {best[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total of the best run of each query",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "median": median,
                "runs": runs,
                "cpus": cpus,
                "spark": spark.version,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
