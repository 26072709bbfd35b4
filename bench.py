"""Time the catalogue: one warm-up, then the median of BENCH_RUNS (3) runs per query.

A run evaluates the whole result into the noop sink, whole jobs, which write
data, as well. Prints one JSON line; BENCH_ONLY=a,b picks queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from partflow.catalogue import CATALOGUE  # noqa: E402
from partflow.session import build_session  # noqa: E402


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    CATALOGUE[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in only or CATALOGUE:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "catalogue_total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "shuffle_partitions": int(cpus),
        "adaptive": spark.conf.get("spark.sql.adaptive.enabled"),
        "spark": spark.version,
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
