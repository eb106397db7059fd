"""Benchmark: headline queries over the driver tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected) after one untimed warm-up.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marginlens.plans import catalog  # noqa: E402
from marginlens.plans.pipeline import run_pipeline  # noqa: E402
from marginlens.sources import testdata  # noqa: E402
from marginlens.plans.session import local_session  # noqa: E402

HEADLINE = [
    "a1_profit_summary",
    "a2_profit_by_year",
    "a3_profit_by_year_category",
    "a4_profit_by_customer",
    "a5_profit_by_customer_year",
    "c7_clean_orders",
    "c11_cleaning_report",
    "e5_enriched_customers",
    "e6_price_tier_range",
    "e8_enriched_products",
    "e9_enriched_orders",
    "r16_top_customer_trends",
    "v3_validate_enriched_orders",
    "v4_validate_profit_summary",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app_name="marginlens-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
    threshold = os.environ.get("BENCH_BROADCAST_THRESHOLD")
    if threshold is not None:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    run(catalog.QUERIES["a2_profit_by_year"](spark, sf_dir))  # warm-up: JVM, codegen, file listing
    timings = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(catalog.QUERIES[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - t0, 3)
    # The whole pipeline: every output of the reference's main program, with
    # the cleaned orders materialised once and shared by all of them.
    t0 = time.perf_counter()
    src = testdata.sources(spark, sf_dir, dirty=True)
    outputs = run_pipeline(src["customers"], src["orders"], src["products"], as_of=catalog.AS_OF, materialize=True)
    for name in sorted(outputs):
        run(outputs[name])
    timings["p1_pipeline_all_outputs"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
