"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query is run to
completion without writing its result, once to warm up and three more times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from seriesloom.plans import catalog, inputs
from seriesloom.session import local_session, release

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "score_filtered",
    "score_summary",
    "gap_fill",
    "lag_set",
    "roll_past",
    "roll_quantile",
    "order_freq",
    "ext_lag",
    "asof_month_limit",
    "same_period_last_year",
    "ema_recursive",
    "croston",
    "profile",
    "weight_groups",
    "silhouette",
    "percentiles",
    "cap_iqr",
    "resample_week_sun",
    "holt_winters",
    "baseline_ext",
    "fit_boosted",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("bench", CPUS)
    run(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    todo = {name: catalog.QUERIES[name] for name in HEADLINE}
    todo["feature_matrix"] = inputs.features_main
    seconds = {}
    for name, query in todo.items():
        times = []
        run(query(spark, SF_DIR))  # warm-up
        while len(times) < 3:
            start = time.perf_counter()
            run(query(spark, SF_DIR))
            times.append(time.perf_counter() - start)
        release(spark)
        seconds[name] = round(median(times), 3)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR)}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
