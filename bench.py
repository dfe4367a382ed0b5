"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.catalog import QUERIES  # noqa: E402
from riskloom.session import local_session  # noqa: E402

HEADLINE = [
    "a05_column_profile", "a06_numeric_summary", "a09_categorical_summary", "t02_mann_whitney",
    "t04_chi_square", "t06_cramers_v", "t07_pearson_pairs", "t10_missingness_vs_target",
    "w04_stratified_split", "f08_fitted_on_train", "e02_exact_auc", "e04_average_precision",
    "e06_youden_threshold", "t11_delong_covariance", "t14_comparison_families",
    "t17_mcnemar_family", "t18_paired_bootstrap", "m01_logisticregression", "x06_local_fits",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores=cpus, spark__ui__showConsoleProgress="false")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall-clock of headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
