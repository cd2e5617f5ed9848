"""Engagement measures over cleaned page views.

Distinct counts are exact. Spark spreads them over (group, page), so one group with a large part of
the rows does not end in one task; the same holds for every per-page sum below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.running import running_totals

PROJECT = ("language", "database_name")


def _active_pages(page: str, approx: float | None) -> Column:
    return F.count_distinct(page) if approx is None else F.approx_count_distinct(page, approx)


def dau(
    df: DataFrame,
    by: Sequence[str] = ("language",),
    date_col: str = "file_date",
    page: str = "page_title",
    approx: float | None = None,
) -> DataFrame:
    """Distinct pages per day and group, in order of days. ``approx`` is a relative error."""
    return (
        df.withColumn(date_col, E.as_date(df, date_col))
        .groupBy(date_col, *by)
        .agg(_active_pages(page, approx).alias("DAU"))
        .orderBy(date_col)
    )


def wau(
    df: DataFrame,
    by: Sequence[str] = PROJECT,
    date_col: str = "file_date",
    page: str = "page_title",
    approx: float | None = None,
) -> DataFrame:
    """Distinct pages per ISO week and group."""
    # Grouped by the week's Monday; the label is made once per group, not once per row.
    return (
        df.withColumn("_monday", F.date_trunc("week", E.as_date(df, date_col)).cast("date"))
        .groupBy("_monday", *by)
        .agg(_active_pages(page, approx).alias("WAU"))
        .select(E.iso_week(F.col("_monday")).alias("week"), *by, "WAU")
    )


def mau(
    df: DataFrame,
    by: Sequence[str] = PROJECT,
    date_col: str = "file_date",
    page: str = "page_title",
    approx: float | None = None,
) -> DataFrame:
    """Distinct pages per calendar month and group."""
    return (
        df.withColumn("_month", F.trunc(E.as_date(df, date_col), "month"))
        .groupBy("_month", *by)
        .agg(_active_pages(page, approx).alias("MAU"))
        .select(E.month_label(F.col("_month")).alias("month"), *by, "MAU")
    )


def stickiness(
    dau_df: DataFrame,
    mau_df: DataFrame,
    by: Sequence[str] = PROJECT,
    how: str = "inner",
    scale: float = 1.0,
    date_col: str = "file_date",
) -> DataFrame:
    """DAU / MAU of each day, times ``scale``, from two measures already at hand."""
    return (
        dau_df.withColumn("month", E.month_label(F.col(date_col)))
        .join(mau_df, [*by, "month"], how)
        .withColumn("stickiness", E.ratio(F.col("DAU"), F.col("MAU")) * F.lit(float(scale)))
    )


def stickiness_from_views(
    df: DataFrame,
    by: Sequence[str] = PROJECT,
    scale: float = 1.0,
    date_col: str = "file_date",
    page: str = "page_title",
) -> DataFrame:
    """DAU, MAU and stickiness straight from page views, with one scan and one large shuffle.

    The days on which a page was seen in a month fit into the bits of one number. Pages are counted
    from those numbers for the month and for each of its days at once, so that page views are not
    shuffled once for DAU and once more for MAU, and nothing is joined.
    """
    day = E.as_date(df, date_col)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth(day))
    page_months = (
        df.dropna(subset=[*by, date_col])
        .groupBy(*by, F.trunc(day, "month").alias("_month"), page)
        .agg(F.bit_or(bit).alias("_days"))
    )
    seen_on = [
        F.sum(F.when(F.col(page).isNotNull(), F.shiftright("_days", d).bitwiseAND(F.lit(1).cast("long"))))
        for d in range(1, 32)
    ]
    months = page_months.groupBy(*by, "_month").agg(
        F.count(page).alias("MAU"), F.bit_or("_days").alias("_any"), F.array(*seen_on).alias("_per_day")
    )
    days = months.select(*by, "_month", "MAU", "_any", F.posexplode("_per_day").alias("_i", "_seen"))
    was_active = F.call_function("shiftright", F.col("_any"), F.col("_i") + 1).bitwiseAND(F.lit(1).cast("long")) == 1
    return days.where(was_active).select(
        *by,
        E.month_label(F.col("_month")).alias("month"),
        F.date_add("_month", F.col("_i")).alias(date_col),
        F.coalesce("_seen", F.lit(0)).alias("DAU"),
        "MAU",
        (E.ratio(F.coalesce("_seen", F.lit(0)), F.col("MAU")) * F.lit(float(scale))).alias("stickiness"),
    )


def diversity(
    df: DataFrame,
    by: Sequence[str] = PROJECT,
    date_col: str = "file_date",
    page: str = "page_title",
    views: str = "count_views",
) -> DataFrame:
    """Distinct pages per view for each day and group; NULL where nothing was viewed."""
    return (
        df.groupBy(E.as_date(df, date_col).alias("dt"), *by)
        .agg(F.count_distinct(page).alias("distinct_pages"), F.sum(views).alias("total_views"))
        .withColumn("diversity_index", E.ratio(F.col("distinct_pages"), F.col("total_views")))
    )


def page_views(
    df: DataFrame,
    by: Sequence[str] = PROJECT,
    date_col: str = "file_date",
    page: str = "page_title",
    views: str = "count_views",
) -> DataFrame:
    """Views per page, day and group."""
    return df.groupBy(E.as_date(df, date_col).alias("dt"), *by, page).agg(F.sum(views).alias("views_page"))


def shannon_entropy(df: DataFrame, by: Sequence[str] = PROJECT, **columns: str) -> DataFrame:
    """Entropy (natural log) of views over the pages of each day and group.

    Both sums are partial aggregates, so a group of any size is summed in parallel.
    """
    v = F.col("views_page")
    return (
        page_views(df, by, **columns)
        .groupBy("dt", *by)
        .agg(F.sum(v).alias("_total"), F.sum(E.v_ln_v(v)).alias("_vlnv"))
        .select("dt", *by, E.entropy_of_sums(F.col("_total"), F.col("_vlnv")).alias("shannon_entropy"))
    )


def page_rank(
    df: DataFrame,
    max_rank: int | None = None,
    by: Sequence[str] = PROJECT,
    page: str = "page_title",
    **columns: str,
) -> DataFrame:
    """Pages of each day and group numbered by views, largest first; equal views go by title.

    With ``max_rank`` only the first pages are listed: every task drops the rest before the
    shuffle. Without it all pages are numbered, by running totals over range partitions.
    """
    pages = page_views(df, by, page=page, **columns)
    order = [F.desc("views_page"), F.asc(page)]
    if max_rank is None:
        return running_totals(pages, order, {"rank": F.lit(1)}, ["dt", *by])
    in_group = Window.partitionBy("dt", *by).orderBy(*order)
    ranked = pages.withColumn("rank", F.row_number().over(in_group)).where(F.col("rank") <= max_rank)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def top_n_share(
    df: DataFrame, ns: Sequence[int] = (10, 100), by: Sequence[str] = PROJECT, **columns: str
) -> DataFrame:
    """Views of the first n pages of each day and group, and their share of all views.

    Only the top max(ns) pages per task are shuffled for ranking. Totals come from all pages; the
    two parts are added up by a union and one small aggregation.
    """
    group = ["dt", *by]
    pages = page_views(df, by, **columns)
    leaders = page_rank(df, max(ns), by, **columns)
    totals = pages.select(*group, F.col("views_page").alias("_total"), *[F.lit(0).cast("long").alias(f"_top{n}") for n in ns])
    tops = leaders.select(
        *group,
        F.lit(0).cast("long").alias("_total"),
        *[F.when(F.col("rank") <= n, F.col("views_page")).otherwise(0).alias(f"_top{n}") for n in ns],
    )
    summed = totals.unionByName(tops).groupBy(*group).agg(
        F.sum("_total").alias("total_views"), *[F.sum(f"_top{n}").alias(f"top{n}_views") for n in ns]
    )
    shares = {f"top{n}_share": E.ratio(F.col(f"top{n}_views"), F.col("total_views")) for n in ns}
    return summed.withColumns(shares)


def dau_share(df: DataFrame, by: str = "language", date_col: str = "file_date", **options) -> DataFrame:
    """Each group's percentage of the day's DAU, summed over groups.

    The window sees one row per day and group, not page views.
    """
    of_day = F.sum("DAU").over(Window.partitionBy(date_col))
    return dau(df, (by,), date_col, **options).select(
        date_col, by, "DAU", of_day.alias("DAU_total"), (E.ratio(F.col("DAU"), of_day) * 100).alias("DAU_pct")
    )


def one_vs_rest(
    shares: DataFrame, one: str = "English", rest: str = "Others", by: str = "language", date_col: str = "file_date"
) -> DataFrame:
    """Shares of one group against all others together."""
    side = F.when(F.col(by) == one, one).otherwise(rest)
    return shares.groupBy(date_col, side.alias(by)).agg(F.sum("DAU_pct").alias("DAU_pct"))
