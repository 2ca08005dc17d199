"""Benchmark the headline queries; prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5). Each query: one warm-up run, then the best of
BENCH_REPEAT runs, each fully executed into the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkcivic.plans.queries import REGISTRY  # noqa: E402
from sparkcivic.session import build_session, scratch_scope  # noqa: E402

HEADLINE = [
    "age_bands", "age_bands_udf", "csv_lines",
    "topk_rate_dense", "topk_rate_sql", "topk_rate_exact",
    "income_per_person", "income_per_person_csv", "income_per_person_bounded",
    "any_code_match", "nearest_site_summary", "code_dictionary",
]


def run(spark, sf_dir: str, name: str) -> float:
    with scratch_scope(spark):  # intermediate tables of this run are deleted after it
        t = time.perf_counter()
        REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", app="sparkcivic-bench", shuffle_partitions=2 * cpus,
                          checkpoint_dir=tempfile.mkdtemp(prefix="bench-"), extra={"spark.driver.memory": "16g"})
    times = {}
    for name in names:
        run(spark, sf_dir, name)
        times[name] = round(min(run(spark, sf_dir, name) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_best_of_%d" % repeat, "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
