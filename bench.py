"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs twice into a sink that reads every row and keeps none; the
faster run counts. ``rows_per_sec`` is output rows over that time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import DataFrame, Observation  # noqa: E402

from tillstone.registry import QUERIES  # noqa: E402
from tillstone.session import build_session  # noqa: E402

HEADLINES = (
    "silver_sales", "fact_sales", "upsert_surrogate_key", "sales_star",
    "silver_inventory", "fact_inventory", "inventory_star",
    "silver_customer", "dim_customer", "dim_product",
    "bronze_sales", "landing_sales", "merge_metrics", "key_uniqueness_audit", "check_referential_integrity",
    "revenue_by_period", "transaction_volume", "product_mix", "customer_demographics",
    "daily_stock_levels", "sell_through_rollup", "top_products_selling_out", "loyalty_engagement",
)
RUNS = 2


def drain(df: DataFrame) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return seen.get["n"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rates = {}, {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(","):
        best, rows = float("inf"), 0
        for _ in range(RUNS):
            start = time.perf_counter()
            rows = drain(QUERIES[name](spark, sf_dir))
            best = min(best, time.perf_counter() - start)
        seconds[name], rates[name] = round(best, 3), round(rows / best)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
