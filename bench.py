"""Benchmark: the twelve marts at one scale factor.

Each mart is fully executed with the ``noop`` sink (every row computed, nothing
collected to the driver); the reported time per mart is the median of
``BENCH_RUNS`` (3) runs, each including plan building. The staging step
(deriving the domain tables from the driver tables and writing them to the
checkpoint folder) is timed once and reported as ``staging``, writing the booking models that
the six booking marts share as ``booking_models``. Then every other
registered query of the inventory runs once, from the driver tables, and is
reported under ``registered`` (``BENCH_REGISTERED=0`` leaves that out). Prints
one JSON line; ``value`` is the sum over staging and marts, as in round 1.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recomart.plans.inventory import AS_OF, MART_RULES, inventory_queries, sources  # noqa: E402
from recomart.plans.marts import MARTS  # noqa: E402
from recomart.plans.staging import stage, stage_models  # noqa: E402
from recomart.session import build_session, ensure_checkpoint_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [m for m in os.environ.get("BENCH_ONLY", "").split(",") if m]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    # Warm-up (not timed): every mart once on the smallest fixture, so JIT and
    # whole-stage codegen compile before timing, as in a long-running session.
    root = ensure_checkpoint_dir(spark).rstrip("/")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        # same code path as the timed runs: materialised staging, then the marts
        warm = stage(sources(spark, warm_dir), f"{root}/bench_warm_{uuid.uuid4().hex}")
        for build in MARTS.values():
            build(warm, AS_OF).write.format("noop").mode("overwrite").save()
    # Staging step (timed, reported as its own entry): derive the domain tables
    # from the driver tables once and write them to the shared checkpoint folder,
    # as the warehouse materialises the staging models the marts read.
    times = {}
    t0 = time.perf_counter()
    folder = f"{root}/bench_staging_{uuid.uuid4().hex}"
    src = sources(spark, sf_dir).materialize(folder)
    times["staging"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()  # the booking models that the six booking marts read
    src = stage_models(src, folder)
    times["booking_models"] = round(time.perf_counter() - t0, 3)

    runs = int(os.environ.get("BENCH_RUNS", "3"))
    for name, build in MARTS.items():
        if only and name not in only:
            continue
        samples = []
        for _ in range(runs):  # median of `runs` (plan building + execution each time)
            t0 = time.perf_counter()
            build(src, AS_OF).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    registered = {}
    if os.environ.get("BENCH_REGISTERED", "1") != "0":
        for name, query in inventory_queries().items():
            if name in MARTS or name in MART_RULES or (only and name not in only):
                continue
            t0 = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            registered[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "marts_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "registered": registered, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
