"""Times the whole run and the headline queries; prints one JSON line.

BENCH_SF_DIR    folder of the input tables
BENCH_CPUS      cores
BENCH_RUNS      timed runs per headline query after one warm-up (default 3); the median counts
BENCH_HEADLINE  set to leave the other queries out; they are timed once after one warm-up
BENCH_WORK      folder for the tables of the run (default: a new one below the temporary folder)

The full refresh starts from CSV landing files written beforehand and rebuilds all
tables.  The other queries read the stored layer below them, as every layer does."""

import json
import os
import platform
import statistics
import tempfile
import time
from pathlib import Path

from ebbtide.plans import registry
from ebbtide.plans.lake import DATASETS, Lake
from ebbtide.plans.run import run_all
from ebbtide.session import local_session
from ebbtide.sources import landing, storage
from ebbtide.sources.feed import raw_feeds

HEADLINE = [
    "bronze_summary", "silver_balances", "silver_hqla", "silver_collateral",
    "silver_vs_bronze_summary", "silver_flag_distribution", "dim_date", "dim_country",
    "dim_subsidiary", "dim_account", "dim_account_scd2", "combined_metrics",
    "fact_intraday_liquidity", "fact_hqla_position", "fact_funding_stability",
    "fact_collateral_risk", "gold_summary", "pk_violations", "fk_orphans", "lcr_two_way",
    "lcr_days_measured", "latest_lcr_snapshot", "hqla_composition", "lcr_trend_by_country",
    "volatility_pivot",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def hardware() -> dict:
    text = Path("/proc/cpuinfo").read_text() if Path("/proc/cpuinfo").exists() else ""
    models = [line.split(":", 1)[1].strip() for line in text.splitlines() if line.startswith("model name")]
    return {
        "cpus": os.cpu_count(), "cpu": models[0] if models else platform.processor(),
        "memory_gb": round(os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30, 1),
        "python": platform.python_version(),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    work = os.environ.get("BENCH_WORK") or tempfile.mkdtemp(prefix="ebbtide-bench-")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), **{"spark.checkpoint.dir": work})

    feeds = raw_feeds(spark, folder)
    base = storage.fresh_folder(spark, "bench-landing")
    paths = {d: landing.write_landing_history(feeds[d], base, d) for d in DATASETS}

    def full_refresh() -> None:
        scans = {d: landing.scan_landing(spark, path, d) for d, path in paths.items()}
        report = run_all(Lake(spark, storage.fresh_folder(spark, "bench"), scans))
        assert all(row.status == "completed" for row in report.collect()), report.collect()

    def measure(action, runs: int) -> float:
        action()
        return round(statistics.median(timed(action) for _ in range(runs)), 3)

    seconds = {"full_refresh": measure(full_refresh, runs)}
    queries = registry.queries()
    more = [] if os.environ.get("BENCH_HEADLINE") else [n for n in queries if n not in HEADLINE]
    for name in [*HEADLINE, *more]:
        seconds[name] = measure(
            lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save(),
            runs if name in HEADLINE else 1,
        )
    headline = sum(seconds[n] for n in ["full_refresh", *HEADLINE])
    print(json.dumps({
        "metric": "headline_query_time", "value": round(headline, 3), "unit": "sec",
        "queries": seconds, "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
        "runs": runs, "hardware": hardware(),
    }))


if __name__ == "__main__":
    main()
