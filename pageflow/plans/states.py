"""Churn data sets of any windows from a stored table of entity days, without reading page views again.

The table has one row per entity, domain code and day: views and the last time of day. Its rows merge (sums
and maxima), so windows are merges over days. It is partitioned by day and bucketed by entity: a pair of
windows reads its own days only, and what groups by entity finds the rows of an entity in one task already,
so a data set takes no shuffle at all. Writing shuffles twice, first by the whole key, so that a page
with very many views is summed in many tasks, then the few rows that are left by entity.

A bucket is read by one task over all days of a window: take as many ``buckets`` as the longest window fills
tasks. They are fixed for the life of a table. Rows of page views without a day are left out; NULL keys
are kept in the table and left out of the data sets, as by ``churn_datasets``. Days are replaced whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import ENTITY_KEYS
from pageflow.operators.features import DAY, Windows, time_number
from pageflow.plans.churn import sets_of_days

VIEWS, TIME = "views_day", "last_time"


def entity_days(views: DataFrame, key_cols: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """States of the days in ``views``: one row per entity, domain code and day."""
    states = views.where(F.col(DAY).isNotNull()).groupBy(*key_cols, "domain_code", DAY)
    return states.agg(F.sum("count_views").alias(VIEWS), F.max(time_number(F.col("file_time"))).alias(TIME)).select(
        *key_cols, "domain_code", VIEWS, TIME, DAY
    )


def merged(*states: DataFrame, key_cols: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """States of several disjoint sets of page views as one: of further views of a day, say, with those stored."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*key_cols, "domain_code", DAY).agg(F.sum(VIEWS).alias(VIEWS), F.max(TIME).alias(TIME)).select(*states[0].columns)


def create_table(states: DataFrame, name: str, path: str, buckets: int, key_cols: Sequence[str] = ENTITY_KEYS) -> None:
    """Writes states to a new table ``name`` of the session's catalog, its files below ``path``."""
    (
        states.repartition(buckets, *[F.col(c) for c in key_cols])
        .write.format("parquet")
        .option("path", path)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .bucketBy(buckets, *key_cols)
        .sortBy(*key_cols)
        .saveAsTable(name)
    )


def replace_days(states: DataFrame, name: str, buckets: int, key_cols: Sequence[str] = ENTITY_KEYS) -> None:
    """Writes the days that occur in ``states`` in place of what the table holds for them; other days stay.

    ``states`` must not read the days it replaces: store merged ones first.
    """
    columns = states.sparkSession.table(name).columns
    rows = states.select(*columns).repartition(buckets, *[F.col(c) for c in key_cols])
    rows.write.mode("overwrite").insertInto(name)


def churn_sets(
    spark: SparkSession,
    name: str,
    windows: Mapping[str, Windows],
    key_cols: Sequence[str] = ENTITY_KEYS,
    features: str = "core",
    frame: str = "rows",
) -> DataFrame:
    """What ``churn_datasets`` gives for the page views, from their states."""
    rows = spark.table(name).withColumnsRenamed({VIEWS: "_v", TIME: "_time"})
    return sets_of_days(rows, windows, key_cols, features, frame, arranged=True)
