"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed fully with the ``noop`` sink (no collect). The first run is cold
(includes planning and JVM warm-up of that code path), the second warm; the reported
per-query time is the warm run, the cold runs are listed separately.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["bhar_window", "cum_bhar", "winsorize_lower_higher", "descriptives", "cluster_twoway",
            "pipeline_regdata", "regression_table", "quantile_rules", "ntile_global", "pearson_spearman",
            "qcut_by_year", "funnel"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from panelspark.session import local_session
    from panelspark.plans.registry import load_all

    spark = local_session(cpus, app="panelspark-bench")
    reg = load_all()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in reg]
    cold, warm = {}, {}
    for name in names:
        for store in (cold, warm):
            t0 = time.perf_counter()
            reg[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
            store[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_warm_sec", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
