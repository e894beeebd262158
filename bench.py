"""Seconds per headline query on the driver tables; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortflow.plans.queries import QUERIES
from cohortflow.session import build_session, clear_staged, name_local_folder

HEADLINE = [
    "timepoint_annual",
    "timepoint_promotion",
    "timepoint_duplicates",
    "locf_filled",
    "locf_full_grid",
    "asof_last_order",
    "scale_standard",
    "label_encode_customers",
    "outlier_iqr",
    "outlier_zscore",
    "outlier_isolation_forest",
    "corr_pearson",
    "corr_spearman",
    "corr_kendall",
    "wide_items",
    "wide_all_stacked",
    "governed_customers",
    "range_deviation_scores",
    "instrument_totals",
    "cluster_kmeans",
    "cluster_ward",
    "write_read_formats",
    "sql_join_aggregate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    name_local_folder(spark)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        clear_staged(spark)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
