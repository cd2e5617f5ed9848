"""Shapes of physical plans that decide how the jobs scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path
from pageflow.operators import features, kpis, maintenance, sampling
from pageflow.plans.churn import churn_dataset, churn_datasets
from pageflow.plans.fixtures import TEST, TRAIN, silver_log
from pageflow.sources.tables import write_table

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, pattern: str) -> int:
    return len(re.findall(pattern, plan(df)))


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "plans")
    write_table(silver_log(spark, SF_DIR), path)
    return spark.read.parquet(path)


def args(w):
    return w.obs_start, w.obs_end, w.lbl_start, w.lbl_end


@pytest.mark.parametrize("kind", ["core", "full"])
def test_churn_set_shuffles_twice_and_joins_nothing(stored, kind):
    df = churn_dataset(stored, *args(TRAIN), features=kind)
    assert count(df, r"Exchange hashpartitioning") == 2
    assert count(df, r"Join") == 0
    assert re.search(r"PartitionFilters: \[isnotnull\(file_date", plan(df))
    assert "count_views" in plan(df) and "total_response_size" not in plan(df)


@pytest.mark.parametrize("kind", ["core", "full"])
def test_page_views_are_hashed_not_sorted(stored, kind):
    before_shuffle = plan(churn_dataset(stored, *args(TRAIN), features=kind)).rsplit("Exchange hashpartitioning", 1)[1]
    assert "HashAggregate" in before_shuffle and "Sort" not in before_shuffle
    before_shuffle = plan(features.last_domain(stored)).rsplit("Exchange hashpartitioning", 1)[1]
    assert "HashAggregate" in before_shuffle and "Sort" not in before_shuffle


def test_two_sets_take_one_scan(stored):
    df = churn_datasets(stored, {"train": TRAIN, "test": TEST})
    assert count(df, r"FileScan") == 1
    assert count(df, r"Exchange hashpartitioning") == 2


def test_silver_never_shuffles(spark):
    df = silver_log(spark, SF_DIR)
    assert count(df, r"Exchange (hash|range|Single)") == 0
    assert count(df, r"BroadcastHashJoin") == 1


def test_stickiness_takes_one_scan(stored):
    assert count(kpis.stickiness_from_views(stored), "FileScan") == 1
    assert count(kpis.stickiness_from_views(stored), r"Join") == 0


def test_top_pages_are_cut_before_the_shuffle(stored):
    assert count(kpis.page_rank(stored, 10), r"WindowGroupLimit") == 2
    copies = stored.withColumn("ingestion_time", F.lit(1))
    assert count(maintenance.dedup_latest(copies, ["page_title"]), r"WindowGroupLimit") == 2


def test_entropy_uses_no_window(stored):
    assert count(kpis.shannon_entropy(stored), r"Window|Join") == 0


def test_fraction_is_a_filter(stored):
    assert count(sampling.sample_fraction(stored, 0.1, ["page_title"]), "Exchange") == 0
