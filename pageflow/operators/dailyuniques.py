"""Distinct pages of days, weeks and months from a daily table, without reading page views again.

Two kinds of daily table, both with rows that merge: sketches of a fixed size with a known error, and
bitmaps over dense page numbers, which are exact. A new or corrected day is written as a partition
of its own (``update_days``); periods are merged from the days whenever they are asked for. NULL pages are not counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.running import running_totals
from pageflow.operators.kpis import PROJECT, stickiness
from pageflow.sources.tables import write_table

# A sketch has 2**LG_K registers.
LG_K = 14
DAY = "file_date"


def relative_error(lg_k: int = LG_K) -> float:
    """Standard error of a merged sketch's estimate, as a share of the true number."""
    return 1.04 / math.sqrt(1 << lg_k)


def period_label(period: str, date_col: str = DAY) -> Column:
    """``"day"`` (2024-01-31), ``"week"`` (ISO, 2024-05) or ``"month"`` (2024-01) of a date, as text."""
    if period == "week":
        return E.iso_week(F.col(date_col))
    if period == "month":
        return E.month_label(F.col(date_col))
    if period == "day":
        return F.col(date_col).cast("string")
    raise ValueError(f"period must be 'day', 'week' or 'month', not {period!r}")


def update_days(daily: DataFrame, path: str, date_col: str = DAY) -> None:
    """Writes the days that occur in ``daily`` to the table, in place of what it holds for them; other days stay."""
    write_table(daily, path, partition_by=date_col, only_partitions=True)


# ---- sketches


def daily_sketches(
    views: DataFrame, by: Sequence[str] = ("language",), page: str = "page_title", date_col: str = DAY, lg_k: int = LG_K
) -> DataFrame:
    """One sketch of the pages per day and group. Tasks sketch their own rows, so only sketches are shuffled."""
    return views.groupBy(E.as_date(views, date_col).alias(date_col), *by).agg(F.hll_sketch_agg(page, lg_k).alias("pages"))


def uniques_of_sketches(
    daily: DataFrame, period: str, by: Sequence[str] = ("language",), name: str = "n_pages", date_col: str = DAY
) -> DataFrame:
    """Estimated distinct pages per period and group, by union of the days' sketches."""
    merged = daily.groupBy(period_label(period, date_col).alias(period), *by).agg(F.hll_union_agg("pages").alias("pages"))
    return merged.select(period, *by, F.hll_sketch_estimate("pages").alias(name))


# ---- bitmaps


def page_numbers(views: DataFrame, known: DataFrame | None = None, page: str = "page_title") -> DataFrame:
    """``page`` and ``page_id``, numbered densely from 0 without holes; pages in ``known`` keep their numbers.

    Only new pages are ordered and numbered, over range partitions.
    """
    pages = views.select(page).where(F.col(page).isNotNull()).distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        pages = pages.join(known.select(page), page, "left_anti")
        start = known.agg(F.count("*").alias("n")).scalar()
    new = running_totals(pages, [page], {"_place": F.lit(1).cast("long")}).select(page, (start + F.col("_place") - 1).alias("page_id"))
    return new if known is None else known.select(page, "page_id").unionByName(new)


def daily_bitmaps(
    views: DataFrame, numbers: DataFrame, by: Sequence[str] = PROJECT, page: str = "page_title", date_col: str = DAY
) -> DataFrame:
    """Per day, group and range of page numbers: which pages were seen, as bits.

    Views are reduced to one row per day, group and page before the join, so a page with very many views is no hot key.
    """
    seen = views.select(E.as_date(views, date_col).alias(date_col), *by, page).distinct().join(numbers, page)
    return seen.groupBy(date_col, *by, F.bitmap_bucket_number("page_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("page_id")).alias("pages")
    )


def uniques_of_bitmaps(
    daily: DataFrame, period: str, by: Sequence[str] = PROJECT, name: str = "n_pages", date_col: str = DAY
) -> DataFrame:
    """Distinct pages per period and group, exact: bits of the days or-ed together and counted."""
    label = F.col(date_col) if period == "day" else period_label(period, date_col)
    column = date_col if period == "day" else period
    merged = daily.groupBy(label.alias(column), *by, "bucket").agg(F.bitmap_or_agg("pages").alias("pages"))
    return merged.groupBy(column, *by).agg(F.sum(F.bitmap_count("pages")).alias(name))


def stickiness_of_bitmaps(daily: DataFrame, by: Sequence[str] = PROJECT, scale: float = 1.0) -> DataFrame:
    """DAU / MAU of each day from the daily bitmaps alone."""
    return stickiness(uniques_of_bitmaps(daily, "day", by, "DAU"), uniques_of_bitmaps(daily, "month", by, "MAU"), by, scale=scale)
