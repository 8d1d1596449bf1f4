"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder and BENCH_CPUS the local cores. Every query is run in full
into a sink that discards its rows; the first run warms the session up and the best of the
following runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from loglattice.registry import CASES
from loglattice.session import build_session

HEADLINE = """
parse_lines decode_records silver_events label_join label_join_large_list dedupe
service_overview service_latency http_status hourly_trend rollup_service_overview
gold_service_risk hourly_service_metrics early_warning_base null_profile cardinality
estate_kpis service_cards insights number_grounding undersample evaluate stream_silver bronze_to_silver stream_silver_runs
""".split()
REPEATS = 2


def run_once(case, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    case.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cases = {case.name: case for case in CASES}
    times = {}
    for name in HEADLINE:
        run_once(cases[name], spark, sf_dir)
        times[name] = round(min(run_once(cases[name], spark, sf_dir) for _ in range(REPEATS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
