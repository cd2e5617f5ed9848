"""Exact first pages of every day and group without shuffling every page: sums of bins bound the pages in them.

Pages are hashed into ``bins`` per day and group, and the positive views of a bin are added up. These sums
merge like any partial aggregate, and no page of a bin can have more views than its bin. The n largest
bins of a group are counted page by page; the n-th page found there is a floor that every first page reaches, so
bins below it hold none. Only the pages of the other bins are counted and ranked, with ties at the floor kept.

The wanted bins go to the tasks as a broadcast table while there are at most ``MOST_BINS``; where more are left
(flat groups, or very many groups) the bounds don't separate, and all pages are ranked instead. The result is the same.
NULL pages are a page of their own, NULL views count as none, and negative views never raise a bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.running import materialize
from pageflow.operators.kpis import PROJECT, page_rank

BINS = 4096
# Rows of a broadcast table of bins: a day, the group's columns and a number each, some 100 bytes.
MOST_BINS = 200_000
BIN = "_bin"


def bin_bounds(views: DataFrame, group: Sequence[str], page: str, count: str, bins: int = BINS) -> DataFrame:
    """Per group and bin, the positive views ``_most`` that bound every page of the bin."""
    return views.groupBy(*group, _bin_of(page, bins)).agg(F.sum(F.greatest(F.col(count), F.lit(0))).alias("_most"))


def _bin_of(page: str, bins: int) -> Column:
    return F.pmod(F.xxhash64(page), F.lit(bins)).cast("int").alias(BIN)


def in_bins(views: DataFrame, chosen: DataFrame, group: Sequence[str], page: str, bins: int = BINS) -> DataFrame:
    """Page views whose bin is among the chosen ones of their group; ``chosen`` has a checked size."""
    binned = views.withColumn(BIN, _bin_of(page, bins))
    return binned.join(F.broadcast(_renamed(chosen)), _same([*group, BIN]), "left_semi").drop(BIN)


def _renamed(table: DataFrame) -> DataFrame:
    return table.withColumnsRenamed({c: f"_by_{c}" for c in table.columns})


def _same(columns: Sequence[str]) -> Column:
    """Equal values in all columns, NULL being equal to NULL."""
    return reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in columns])


def floors(leaders: DataFrame, n: int, group: Sequence[str]) -> DataFrame:
    """Views of the n-th page of each group, or NULL where fewer pages were found."""
    return leaders.groupBy(*group).agg(F.max(F.when(F.col("rank") == n, F.col("views_page"))).alias("_floor"))


def top_pages(
    df: DataFrame,
    n: int,
    by: Sequence[str] = PROJECT,
    date_col: str = "file_date",
    page: str = "page_title",
    views: str = "count_views",
    bins: int = BINS,
    most_bins: int = MOST_BINS,
) -> DataFrame:
    """The first n pages of each day and group with their rank, as ``kpis.page_rank(df, n)`` gives them."""
    if n < 1:
        raise ValueError("n must be at least 1")
    group = ["dt", *by]
    columns = {"date_col": "dt", "page": page, "views": views}
    rows = df.select(E.as_date(df, date_col).alias("dt"), *by, page, views)
    bounds = materialize(bin_bounds(rows, group, page, views, bins))

    largest = Window.partitionBy(*group).orderBy(F.desc("_most"), F.asc(BIN))
    first = bounds.withColumn("_place", F.row_number().over(largest)).where(F.col("_place") <= n).select(*group, BIN)
    if first.limit(most_bins + 1).count() > most_bins:
        return page_rank(rows, n, by, **columns)
    leaders = page_rank(in_bins(rows, first, group, page, bins), n, by, **columns)

    floor = _renamed(floors(leaders, n, group))
    above = F.col("_by__floor").isNull() | (F.col("_most") >= F.col("_by__floor"))
    wanted = materialize(bounds.join(floor, _same(group), "left").where(above).select(*group, BIN))
    if wanted.limit(most_bins + 1).count() > most_bins:
        return page_rank(rows, n, by, **columns)
    return page_rank(in_bins(rows, wanted, group, page, bins), n, by, **columns)
