"""Compare physical strategies for the two heavy operators.

* J4 full outer reconciliation of M1's inputs: plain FULL JOIN; inner join plus both
  anti joins (ours), with a cheap key source and with the side's own keys.
* A1/A2 re-aggregation of M6's deals: explode + GROUP BY + ordered listagg
  (source form) vs. merging the per-row arrays (our form).

Each variant runs with the ``noop`` sink; rounds are interleaved so host noise
hits all variants alike; the median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from recomart.functions import labels as L  # noqa: E402
from recomart.operators.aggregate import string_agg  # noqa: E402
from recomart.operators.reconcile import full_outer_reconcile  # noqa: E402
from recomart.operators.unnest import explode_keep_empty, explode_primary  # noqa: E402
from recomart.plans import marts as M  # noqa: E402
from recomart.plans.deals import AGG_NOT_SELECTED, DealRules, _derived, stage_deals  # noqa: E402
from recomart.plans.inventory import AS_OF, sources  # noqa: E402
from recomart.plans.product import booking_contact_keys, enriched_bookings  # noqa: E402
from recomart.session import build_session, ensure_checkpoint_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(master="local[8]", shuffle_partitions=16,
                          extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    root = ensure_checkpoint_dir(spark).rstrip("/")
    src = sources(spark, sf_dir).materialize(f"{root}/strategies_{uuid.uuid4().hex}")

    def m1_sides():
        left = M._pfx(M.crm_bookings(src, M.M1, AS_OF), "pd__")
        right = M._pfx(enriched_bookings(src, AS_OF, "landlord"), "prd__")
        return left, right

    def plain():
        left, right = m1_sides()
        return left.join(right, F.col("pd__email") == F.col("prd__email"), "full")

    def split():
        left, right = m1_sides()
        return full_outer_reconcile(left, right, "pd__email", "prd__email",
                                    right_keys=booking_contact_keys(src, "landlord"))

    def split_own_keys():
        left, right = m1_sides()
        return full_outer_reconcile(left, right, "pd__email", "prd__email")

    def a2_exploded():
        rows = explode_primary(src.deals.where(F.col("pipeline_id") == L.TENANT_PIPELINE))
        rows = explode_keep_empty(rows, "te_cities_cleaned", "__city")
        staged = rows.select(*_derived(DealRules(city="aggregate"), AS_OF), "__city").drop(*AGG_NOT_SELECTED)
        keys = [c for c in staged.columns if c != "__city"]
        return staged.groupBy(*keys).agg(string_agg("__city").alias("city"))

    def a2_arrays():
        return stage_deals(src.deals, DealRules(city="aggregate"), AS_OF, pipeline=L.TENANT_PIPELINE)

    variants = {"j4_plain_full": plain, "j4_inner_and_anti": split, "j4_inner_and_anti_own_keys": split_own_keys, "a2_explode_groupby_listagg": a2_exploded,
                "a2_array_merge": a2_arrays}
    for build in variants.values():  # warm-up
        build().write.format("noop").mode("overwrite").save()
    samples = {k: [] for k in variants}
    for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
        for name, build in variants.items():
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            samples[name].append(time.perf_counter() - t0)
    print(json.dumps({"sf_dir": sf_dir, "median_sec": {k: round(statistics.median(v), 3) for k, v in samples.items()}}))


if __name__ == "__main__":
    main()
