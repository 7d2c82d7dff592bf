"""Time the operators at the published workload sizes, on generated inputs.

50,000 customers, 5,000,000 transactions, 10,000,000 points, 4,500,000 rectangles, and 500,000
points for the density report. Inputs are written to a new folder once, as parquet, and not timed.

    python bench_workload.py <new folder> [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridledger import operators as op  # noqa: E402
from gridledger.session import build_session  # noqa: E402
from gridledger.sources import generators as gen  # noqa: E402


def main(folder: str, chosen: list[str]) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "gridledger-workload",
        master=f"local[{cpus}]",
        shuffle_partitions=4 * int(cpus),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "20g", "spark.local.dir": f"{folder}/spill"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stored(name, df):
        path = f"{folder}/{name}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    c = stored("customers", gen.gen_customers(spark))
    t = stored("transactions", gen.gen_transactions(spark))
    p = stored("points", gen.gen_points(spark))
    few = stored("few_points", gen.gen_points(spark, 500_000))
    r = stored("rectangles", gen.gen_rectangles(spark))
    s = stored("seeds", gen.gen_seeds(spark, 10))
    density = op.relative_density(few)
    queries = {
        "customer_txn_summary": lambda: op.customer_txn_summary(c, t),
        "country_txn_report": lambda: op.country_txn_report(c, t),
        "age_gender_spend": lambda: op.age_gender_spend(c, t),
        "least_active_customers": lambda: op.least_active_customers(c, t),
        "country_size_outliers": lambda: op.country_size_outliers(c),
        "items_spend_stats": lambda: op.items_spend_stats(t),
        "rare_big_spenders": lambda: op.rare_big_spenders(t),
        "top_dense_cells": lambda: op.top_dense_cells(density),
        "top_dense_neighbors": lambda: op.top_dense_neighbors(density),
        "kmeans": lambda: op.kmeans(p, s),
        "distance_outliers": lambda: op.distance_outliers(p, 50, 3),
        "spatial_join": lambda: op.spatial_join(p, r),
        "spatial_join_window": lambda: op.spatial_join(p, r, window=(2000, 1000, 6000, 7000)),
    }
    for name, query in queries.items():
        if chosen and name not in chosen:
            continue
        started = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        print(json.dumps({"query": name, "seconds": round(time.perf_counter() - started, 2)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
