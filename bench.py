"""Benchmark: run every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full with the ``noop`` sink (every row computed, nothing collected to the driver)
after one warm-up pass over the flagship query. Prints one JSON line:
``{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridepulse.plans.catalog import QUERIES  # noqa: E402
from ridepulse.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    only = [q for q in sys.argv[1:] if q in QUERIES]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "6g")})
    QUERIES["gold_route_performance_hourly"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in (only or list(QUERIES)):
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others' timings
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(v for v in times.values() if v is not None), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
