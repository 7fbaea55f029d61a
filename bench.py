"""Headline timings as one JSON line; ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and cores."""

from __future__ import annotations

import json
import os
import time

from checks.queries import REGISTRY
from creditframe.session import local_session

HEADLINE = [
    "vintage_default_table",
    "fico_ltv_grid",
    "vintage_seasoning",
    "worst_delinquency",
    "states_by_default_rate",
    "interpolated_balances",
    "hazard_panel",
    "default_rate_by_quarter",
    "book_by_quarter",
    "stress_headline",
    "shock_grid",
    "segment_report",
    "train_test_ranking_metrics",
    "score_reliability",
    "applicant_portfolio_loss",
    "default_hazard_coefficients",
]


def timed(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and compute every row of it."""
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)  # warm-up: class loading, code generation, file cache
        times[name] = round(timed(spark, name, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
