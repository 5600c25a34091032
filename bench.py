"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import make_session  # noqa: E402
from tidemark.plans import registry  # noqa: E402

HEADLINE = [
    "price_alerts",
    "price_stats",
    "price_history",
    "current_prices",
    "lineitem_price_alerts",
    "lineitem_price_stats",
    "lineitem_quantiles",
    "lineitem_outlier_summary",
    "lineitem_regression",
    "central_tendency",
    "dispersion",
    "full_summary",
    "change_volatility",
    "outlier_summary",
    "welch_t",
    "mann_whitney",
    "kruskal",
    "anova",
    "confidence_interval",
    "log_price_model",
    "run_checks",
    "parse_prices",
    "pages_two_step",
    "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(registry.QUERIES)
    spark = make_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # Load classes, generated code and Python workers on the smallest tables before anything is timed.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            run(name, warm_dir)
    took = {name: run(name, sf_dir) for name in names}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
