"""Bench: the production flow at one scale factor, timed per table / query.

driver tables -> silver (partitioned Parquet) -> gold (6 tables) -> marts (12)
-> read-side queries over the written marts.  Every step is forced with a full
write (Parquet, or the ``noop`` sink for read-side queries), never a collect.
Within a stage, independent tables run as concurrent jobs (BENCH_WORKERS,
default 4), and the 40 read-side queries run that many at a time, as a
dashboard page issues them together; ``stage.*`` entries are stage wall
times, per-table / per-query entries overlap.

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries": {...}, "sf"}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WORKERS (default 4); MERCATO_EVENT_LOG_DIR writes Spark's event log there.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import types
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.plans import pipeline  # noqa: E402
from mercato.plans.queries import _D  # noqa: E402
from mercato.sources import sinks  # noqa: E402
from mercato.session import local_session  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app_name="mercato-bench")
    root = sinks.scratch_path(spark, "bench")
    # Untimed JVM warm-up (class loading, JIT) on the smallest tables.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir.rstrip("/"):
        pipeline.run_all(spark, warm_dir, sinks.scratch_path(spark, "warmup"))
    silver_root, gold_root, marts_root = (os.path.join(root, p) for p in ("silver", "gold", "marts"))
    times: dict[str, float] = {}

    def timed(name: str, fn) -> None:
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    workers = int(os.environ.get("BENCH_WORKERS", "4"))
    reports: dict[str, pipeline.StageReport] = {}
    start = time.perf_counter()
    timed("stage.silver_landing", lambda: reports.__setitem__(
        "silver", pipeline.silver_from_testdata(spark, sf_dir, silver_root, workers)))
    timed("stage.gold", lambda: reports.__setitem__(
        "gold", pipeline.gold(spark, silver_root, gold_root, workers=workers)))
    timed("stage.marts", lambda: reports.__setitem__(
        "marts", pipeline.marts(spark, gold_root, silver_root, marts_root, workers=workers)))
    # Per-table seconds inside a stage overlap when workers > 1.
    for stage, prefix in (("silver", "silver."), ("gold", "gold."), ("marts", "mart.")):
        for name, seconds in reports[stage].seconds.items():
            times[prefix + name] = seconds
    tables = pipeline.serving_views(spark, gold_root, marts_root)
    gold_ns = types.SimpleNamespace(**{k: tables[k] for k in pipeline.GOLD_TABLES},
                                    tables=lambda: {k: tables[k] for k in pipeline.GOLD_TABLES})
    ctx = types.SimpleNamespace(spark=spark, gold=gold_ns,
                                marts=types.SimpleNamespace(**{k: tables[k] for k in tables}))
    def serve(item):
        name, build = item
        pipeline.describe(spark, f"serve {name}")
        t = time.perf_counter()
        _noop(build(ctx))
        return name, round(time.perf_counter() - t, 3)

    # A dashboard page issues its queries together: run them `workers` at a time.
    def serve_all() -> None:
        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            for name, seconds in pool.map(serve, _D.items()):
                times[f"serve.{name}"] = seconds

    timed("stage.serve", serve_all)
    total = round(time.perf_counter() - start, 3)

    sf_match = re.search(r"sf([0-9.]+)", sf_dir.rstrip("/"))
    print(json.dumps({
        "metric": "pipeline_wall_time",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "cpus": cpus,
        "workers": workers,
        "warmup": "one untimed pipeline run on " + warm_dir if os.path.isdir(warm_dir) else "none",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
