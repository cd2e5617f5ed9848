"""Churn sets from a stored table of entity days: equal to those from page views, without shuffles, days replaced."""

from __future__ import annotations

import datetime
import re
import uuid

import pytest
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path
from pageflow.operators.features import Windows
from pageflow.plans import states
from pageflow.plans.churn import churn_datasets
from pageflow.plans.fixtures import TEST, TRAIN, silver_log
from pageflow.sources.tables import write_table

SF_DIR = "/root/testdata/sf0.001"
LATE = datetime.date(2024, 1, 10)
SETS = {"train": TRAIN, "test": TEST}


@pytest.fixture(scope="module")
def views(spark):
    path = scratch_path(spark, "state-views")
    write_table(silver_log(spark, SF_DIR), path)
    return spark.read.parquet(path)


@pytest.fixture()
def table(spark, views):
    name = f"states_{uuid.uuid4().hex}"
    states.create_table(states.entity_days(views), name, scratch_path(spark, "states"), 4)
    yield name
    spark.sql(f"drop table {name}")


def rows(df):
    columns = sorted(df.columns)
    return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*columns).collect())


@pytest.mark.parametrize("kind", ["core", "full"])
@pytest.mark.parametrize("frame", ["rows", "days"])
def test_equal_to_the_sets_of_page_views(spark, views, table, kind, frame):
    got = states.churn_sets(spark, table, SETS, features=kind, frame=frame)
    assert rows(got) == rows(churn_datasets(views, SETS, features=kind, frame=frame)) != []


@pytest.mark.parametrize("kind", ["core", "full"])
def test_no_exchange_and_own_days_only(spark, table, kind):
    later = Windows.of("2024-01-12", "2024-01-15", "2024-01-17", "2024-01-18")
    df = states.churn_sets(spark, table, {"later": later}, features=kind)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Bucketed: true" in plan
    read = {re.search(r"file_date=([\d-]+)", f).group(1) for f in df.inputFiles()}
    assert read == {f"2024-01-{d}" for d in (12, 13, 14, 15, 17, 18)}


def test_one_file_per_bucket_and_day(spark, table):
    files = spark.table(table).inputFiles()
    days = spark.table(table).select("file_date").distinct().count()
    assert len(files) <= 4 * days


def test_days_are_replaced_or_merged(spark, views, table):
    late = views.where(F.col("file_date") == F.lit(LATE)).withColumn("count_views", F.col("count_views") + 1)
    late = late.unionByName(late.limit(1).withColumns({"page_title": F.lit("brand new"), "file_time": F.lit("23:00:00")}))
    stay = set(spark.table(table).where(F.col("file_date") != F.lit(LATE)).inputFiles())
    path = scratch_path(spark, "merged")
    stored = spark.table(table).where(F.col("file_date") == F.lit(LATE))
    states.merged(stored, states.entity_days(late)).write.parquet(path)
    states.replace_days(spark.read.parquet(path), table, 4)
    both = views.unionByName(late)
    assert rows(spark.table(table)) == rows(states.entity_days(both))
    assert stay <= set(spark.table(table).inputFiles())
    expected = churn_datasets(both, SETS, features="full")
    assert rows(states.churn_sets(spark, table, SETS, features="full")) == rows(expected)


def test_odd_rows(spark):
    day = datetime.date(2024, 1, 1)
    given = [("a", "en", 3, day, "01:00:00"), (None, "en", 2, day, "02:00:00"), ("a", None, 1, day, None), ("a", "en", 5, None, "03:00:00")]
    views = spark.createDataFrame(given, "k string, domain_code string, count_views long, file_date date, file_time string")
    window = {"x": Windows.of("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04")}
    for some in (views, views.limit(0)):
        name = f"states_{uuid.uuid4().hex}"
        states.create_table(states.entity_days(some, ["k"]), name, scratch_path(spark, "odd"), 2, ["k"])
        for kind in ("core", "full"):
            got = states.churn_sets(spark, name, window, ["k"], kind)
            assert rows(got) == rows(churn_datasets(some, window, ["k"], kind))
        spark.sql(f"drop table {name}")
