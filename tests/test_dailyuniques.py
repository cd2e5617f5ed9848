"""Distinct pages from daily sketches and bitmaps: exactness, error, new and corrected days."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pageflow.operators import dailyuniques as D
from pageflow.sources.tables import read_table

SCHEMA = "file_date date, language string, database_name string, page_title string"


def log(seed, days, pages=400, rows=3_000):
    rng = random.Random(seed)
    return [
        (datetime.date(2024, 1, rng.choice(days)), rng.choice(["en", "it", None]), "w", rng.choice(["hot", None, f"p{rng.randrange(pages)}"]))
        for _ in range(rows)
    ]


def exact(rows, period):
    label = {"day": lambda d: d, "week": lambda d: "%04d-%02d" % d.isocalendar()[:2], "month": lambda d: f"{d:%Y-%m}"}[period]
    seen = {}
    for d, lang, base, page in rows:
        if page is not None:
            seen.setdefault((label(d), lang, base), set()).add(page)
    return {k: len(v) for k, v in seen.items()}


@pytest.mark.parametrize("period", ["day", "week", "month"])
def test_bitmaps_are_exact_over_batches_and_corrections(spark, tmp_path, period):
    path, numbers, kept = str(tmp_path / "bitmaps"), None, {}
    # The third batch corrects days of the first and brings pages that no day had.
    for seed, days, pages in ((1, list(range(1, 11)), 300), (2, list(range(11, 32)), 500), (3, [4, 5], 40_000)):
        rows = log(seed, days, pages)
        part = spark.createDataFrame(rows, SCHEMA)
        numbers = D.page_numbers(part, numbers)
        D.update_days(D.daily_bitmaps(part, numbers), path)
        kept = {d: r for d, r in kept.items() if d not in days} | {d: [x for x in rows if x[0].day == d] for d in days}
    ids = sorted(r.page_id for r in numbers.collect())
    assert ids == list(range(len(ids)))
    got = D.uniques_of_bitmaps(read_table(spark, path), period).collect()
    want = exact([x for r in kept.values() for x in r], period)
    assert {(r[0], r.language, r.database_name): r.n_pages for r in got} == want


def test_numbers_stay_when_pages_come(spark):
    first = D.page_numbers(spark.createDataFrame(log(1, [1]), SCHEMA))
    both = D.page_numbers(spark.createDataFrame(log(2, [1], 900), SCHEMA), first)
    old = {r.page_title: r.page_id for r in first.collect()}
    new = {r.page_title: r.page_id for r in both.collect()}
    assert len(new) > len(old) and all(new[p] == i for p, i in old.items())
    assert D.page_numbers(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketches_stay_within_their_error(spark):
    """Forty merged estimates of 100,000 to 200,000 pages, at three sizes of sketch."""
    rows = spark.range(800_000).select(
        F.date_add(F.lit(datetime.date(2024, 1, 1)), (F.col("id") % 10).cast("int")).alias("file_date"),
        (F.col("id") % 4).cast("string").alias("language"),
        (F.col("id") % F.lit(500_000)).cast("string").alias("page_title"),
    )
    want = {r.language: r.n for r in rows.groupBy("language").agg(F.count_distinct("page_title").alias("n")).collect()}
    for lg_k in (10, 12, 14):
        daily = D.daily_sketches(rows, lg_k=lg_k)
        got = D.uniques_of_sketches(daily, "month").collect()
        assert all(abs(r.n_pages / want[r.language] - 1) < 4 * D.relative_error(lg_k) for r in got) and len(got) == 4
    assert D.relative_error(14) < 0.0082


def test_a_day_written_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "sketches")
    for seed in (1, 1, 5):
        D.update_days(D.daily_sketches(spark.createDataFrame(log(seed, [3]), SCHEMA)), path)
    D.update_days(D.daily_sketches(spark.createDataFrame(log(6, [9]), SCHEMA)), path)
    got = {(r.day, r.language): r.n_pages for r in D.uniques_of_sketches(read_table(spark, path), "day").collect()}
    want = exact([*log(5, [3]), *log(6, [9])], "day")
    assert got == {(str(d), lang): n for (d, lang, _), n in want.items()}


def test_odd_periods(spark):
    daily = D.daily_sketches(spark.createDataFrame([], SCHEMA))
    assert D.uniques_of_sketches(daily, "week").count() == 0
    with pytest.raises(ValueError):
        D.period_label("year")
