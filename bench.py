"""Benchmark: the full warehouse build at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Runs the layer pipeline (9 silver tables, 6 gold tables, 9 marts, each
written to Parquet and read back by the next layer) and then a set of
operator queries over the built warehouse (forced with the ``noop`` sink, so
nothing is collected). Prints ONE JSON line:

    {"metric": "warehouse_build_and_queries", "value": <total sec>, "unit": "sec",
     "queries": {...per table / query seconds...}, "sf": ..., "warmup_sec": ...}

Before the timed run the same pipeline and queries run once, untimed, over the
smallest driver data set (``$BENCH_WARMUP_DIR``, default sf0.001; empty = skip):
a fresh JVM otherwise spends much of the first run compiling (JIT, and code
generation for every new plan shape), a cost a long-lived cluster session pays
once. Its wall time is reported as ``warmup_sec``; nothing from it is reused
except the compiled code (different input, different output folder).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# operator queries over the built warehouse (silver/gold/marts read from the written layers;
# bronze-level queries read the inputs)
HEADLINE_QUERIES = ["dq_time_order", "dq_nulls", "dq_orphans", "cln_dedupe_key", "cln_majority",
                    "jn_star", "jn_role_dates", "agg_conditional_distinct", "agg_corr",
                    "agg_pivot", "agg_histogram", "win_surrogate_key", "win_ntile", "win_lag",
                    "win_rolling", "win_mode", "qry_top_categories", "qry_seller_rankings",
                    "qry_kpi_days", "an_churn_label", "an_geo_features", "cln_accent_fold"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from marketlake.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"})
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed

    from marketlake.plans.catalog import QUERIES  # noqa: F401  (registers every query)
    from marketlake.plans.pipeline import run_layers
    from marketlake.plans.registry import BY_WAREHOUSE
    from marketlake.plans.warehouse import LayerWarehouse

    def run(data_dir: str) -> tuple[dict, dict]:
        # layers go to a fresh folder under the session's spark.checkpoint.dir (shared
        # storage on a cluster; a private scratch folder only when the setting is unset)
        t0 = time.perf_counter()
        res = run_layers(spark, data_dir)
        timings = {k.replace("/", "."): v for k, v in res["timings"].items()}
        timings["pipeline_total"] = round(time.perf_counter() - t0, 3)
        built = LayerWarehouse(spark, data_dir, res["root"])
        for name in HEADLINE_QUERIES:
            t1 = time.perf_counter()
            BY_WAREHOUSE[name](built).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t1, 3)
        timings["_total"] = round(time.perf_counter() - t0, 3)
        return timings, res

    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warmup = None
    if warmup_dir and os.path.isdir(warmup_dir) and warmup_dir.rstrip("/") != sf_dir.rstrip("/"):
        warmup = run(warmup_dir)[0]["_total"]
    timings, _ = run(sf_dir)
    total = timings.pop("_total")
    print(json.dumps({"metric": "warehouse_build_and_queries", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "warmup_sec": warmup}))
    spark.stop()


if __name__ == "__main__":
    main()
