"""Benchmark the headline queries at one scale factor and print ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 2; best run kept).
Each query is executed in full through the ``noop`` sink (no driver collect of results).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["matmul_mm", "act_softmax", "mean_axis0", "loss_cross_entropy", "ew_add", "batchnorm_train",
            "grad_unary", "dp_gradient_linear", "dp_gradient_mlp", "grad_matmul", "adam_two_steps",
            "kv_samples", "loss_log_curve", "coll_all_reduce", "train_mlp"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from tablegrad.plans.catalog import QUERIES
    from tablegrad.session import get_session

    spark = get_session(f"local[{cpus}]", app="tablegrad-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            spark.catalog.clearCache()  # every repeat starts uncached
            t0 = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
