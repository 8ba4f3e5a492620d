"""Benchmark: the full as-of run over stored layers, one timing per step.

Reads the driver tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "run_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each step is run on a fresh output folder per repetition; the reported time
per step is the median of $BENCH_REPS runs (default 3), after one warm-up run
that loads the JVM and the parquet footers.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.run import LayerRun  # noqa: E402
from tidemark.session import build_session, ensure_checkpoint_dir, shared_path  # noqa: E402
from tidemark.settings import fixture_settings  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    # outputs go under the session's shared checkpoint folder (never a machine-local temp dir)
    scratch = shared_path(spark, f"tidemark-bench-{uuid.uuid4().hex}")
    settings = fixture_settings()
    runs = []
    t_all = time.perf_counter()
    for i in range(reps + 1):
        run = LayerRun(spark, sf_dir, os.path.join(scratch, f"run{i}"), settings)
        runs.append(dict(run.run_all()))
    wall = time.perf_counter() - t_all
    measured = runs[1:] if len(runs) > 1 else runs
    queries = {k: round(statistics.median(r[k] for r in measured), 3) for k in measured[0]}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "run_total_sec",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "reps": reps,
        "wall_sec": round(wall, 1),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
