"""First pages by bounds of bins against the plain ranking."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from pageflow.functions.running import materialize
from pageflow.operators import kpis, topn

DAY = datetime.date(2024, 1, 1)
SCHEMA = "file_date date, language string, database_name string, page_title string, count_views long"


def rows_of(df):
    columns = ["dt", "language", "database_name", "page_title", "views_page", "rank"]
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))


@pytest.fixture(scope="module")
def skewed(spark):
    """One language with most pages, few of them with most views; a flat language; ties at the floor."""
    rows = spark.range(60_000).select(
        F.lit(DAY).alias("file_date"),
        F.when(F.col("id") % 10 < 8, "English").otherwise("Italian").alias("language"),
        F.lit("w").alias("database_name"),
        F.concat(F.lit("P"), (F.col("id") % 20_011).cast("string")).alias("page_title"),
        F.when((F.col("id") % 20_011 < 40) & (F.col("id") % 10 < 8), 1_000).otherwise(1).cast("long").alias("count_views"),
    )
    return materialize(rows)


@pytest.mark.parametrize("n", [3, 500])
@pytest.mark.parametrize("bins", [7, 4096])
def test_equals_the_plain_ranking(skewed, n, bins):
    assert rows_of(topn.top_pages(skewed, n, bins=bins)) == rows_of(kpis.page_rank(skewed, n))


def test_falls_back_where_bounds_do_not_separate(skewed):
    assert rows_of(topn.top_pages(skewed, 5, most_bins=3)) == rows_of(kpis.page_rank(skewed, 5))


def test_most_pages_are_not_ranked(skewed):
    """Of a language with a few very large pages, only the pages in few bins are left."""
    english = skewed.where("language = 'English'").withColumnRenamed("file_date", "dt")
    group = ["dt", "language", "database_name"]
    bounds = topn.bin_bounds(english, group, "page_title", "count_views")
    wanted = bounds.where("_most >= 1000").select(*group, topn.BIN)
    left = topn.in_bins(english, wanted, group, "page_title").select("page_title").distinct().count()
    assert left < 0.05 * english.select("page_title").distinct().count()


def test_odd_rows(spark):
    """NULL groups, pages and views, negative views, repeated rows, fewer pages than asked for."""
    rows = [
        (DAY, None, "w", "a", 5), (DAY, None, "w", "a", 5), (DAY, None, "w", None, 7), (DAY, None, "w", "b", None),
        (DAY, "English", None, "a", -3), (DAY, "English", None, "b", 0), (DAY, "English", None, "c", -9), (None, "x", "w", "a", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for n in (1, 2, 10):
        assert rows_of(topn.top_pages(df, n, bins=3)) == rows_of(kpis.page_rank(df, n))
    assert topn.top_pages(df.where("false"), 3).count() == 0
    with pytest.raises(ValueError):
        topn.top_pages(df, 0)
