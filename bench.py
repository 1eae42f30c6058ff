"""Headline timings: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed fully with the no-op sink (no collect); the basket derivation (star tables → stored
basket tables) is timed on its own, the mart and result queries then read the stored tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trolley.plans import registry  # noqa: E402
from trolley.session import local_session  # noqa: E402
from trolley.sources.basket import load_basket  # noqa: E402

HEADLINE = [
    "prior_lines",
    "product_mart",
    "user_mart",
    "user_product_mart",
    "data_mart",
    "train_set",
    "test_set",
    "label_coverage",
    "null_counts",
    "submission",
    "roc_curve",
    "auc_exact",
    "evaluate_report",
    "forest_predict",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="trolley-bench")
    qs = registry.all_queries()
    times: dict[str, float] = {}

    t0 = time.perf_counter()
    load_basket(spark, sf_dir)
    times["basket"] = round(time.perf_counter() - t0, 3)

    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
