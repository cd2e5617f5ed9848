"""Times the headline queries and prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; each query runs once to warm up, then
``$BENCH_RUNS`` times, and the median counts. Results go to a sink that drops them. ``compared``
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import ENTITY_KEYS
from pageflow.operators import features, kpis
from pageflow.plans.fixtures import TRAIN, silver_log
from pageflow.plans.queries import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "bronze_parse_lines",
    "quality_report",
    "silver_pipeline",
    "dau",
    "wau",
    "mau",
    "stickiness",
    "stickiness_one_pass",
    "diversity",
    "shannon_entropy",
    "top_n_share",
    "page_rank_daily",
    "dau_share",
    "daily_vs_hourly",
    "daily_entity_views",
    "rolling_sum_7",
    "domain_entropy",
    "churn_labels",
    "churn_dataset_core",
    "churn_dataset_full",
    "train_test_sets",
    "feature_box_stats",
    "late_upsert",
    "cluster_rewrite",
    "sample_n",
    "stratified_split_exact",
    "roc_auc",
    "classification_report",
    "gbt_predictions",
]


def entropy_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = ["dt", *kpis.PROJECT]
    pages = kpis.page_views(silver_log(spark, sf_dir))
    shares = pages.join(pages.groupBy(*group).agg(F.sum("views_page").alias("t")), group)
    p = F.try_divide("views_page", "t")
    return shares.groupBy(*group).agg(F.sum(-p * F.ln(p)).alias("shannon_entropy"))


def churn_core_by_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_log(spark, sf_dir)
    daily = features.daily_views(features.observation_rows(rows, TRAIN))
    later = features.label_rows(rows, TRAIN).select(*ENTITY_KEYS).distinct().withColumn("alive", F.lit(1))
    labels = daily.select(*ENTITY_KEYS).distinct().join(later, ENTITY_KEYS, "left")
    last = features.last_day_snapshot(daily, TRAIN.obs_end)
    return features.entity_features(daily).join(last, ENTITY_KEYS, "left").join(labels, ENTITY_KEYS)


COMPARED = {"entropy_by_join": entropy_by_join, "churn_core_by_joins": churn_core_by_joins}


def seconds(spark: SparkSession, query) -> float:
    start = time.monotonic()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.monotonic() - start


def measure(spark: SparkSession, query) -> float:
    seconds(spark, query)
    return round(statistics.median(seconds(spark, query) for _ in range(RUNS)), 3)


def main() -> None:
    warnings.simplefilter("ignore")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    names = sys.argv[1:] or HEADLINE
    timed = {name: measure(spark, registered[name]) for name in names if name in registered}
    compared = {name: measure(spark, query) for name, query in COMPARED.items() if not sys.argv[1:] or name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "compared": compared,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
