"""Hand-made rows for the rules of cleaning, measures and features."""

from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.fixed_values import LANGUAGES, NAMESPACES, SPECIAL_DOMAINS
from pageflow.operators import cleaning, features, kpis, profiles
from pageflow.plans.churn import churn_dataset, train_test_sets
from pageflow.sources import landing, raw

LOG = "domain_code string, page_title string, count_views bigint, total_response_size bigint"


def day(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


def test_fixed_values():
    assert len(LANGUAGES) == 184
    assert len(NAMESPACES) == len(set(NAMESPACES)) == 36
    assert not set(SPECIAL_DOMAINS) & set(LANGUAGES)


@pytest.mark.parametrize("language_map", [False, True])
def test_domain_parts(spark, language_map):
    codes = ["en", "en.m", "en.m.voy", "en.b.q", "it.wd", "commons.m", "xx", "simple", "EN", "www.wd", "", None]
    rows = spark.createDataFrame([(c,) for c in codes], "domain_code string")
    got = {r[0]: tuple(r[1:]) for r in cleaning.derive_domain(rows, language_map).collect()}
    assert got == {
        "en": ("English", "wikipedia.org", False),
        "en.m": ("English", "wikipedia.org", True),
        "en.m.voy": ("English", "wikivoyage", True),
        "en.b.q": ("English", "wikibooks", False),
        "it.wd": ("Italian", "wikidatawiki", False),
    }


def test_titles(spark):
    titles = ["A:B:C", "File:B:C", ":X", "Talk:", "noc", "User talk:Z", "User_talk:Z", "Star_Trek:_X", "Talk:é:ß"]
    rows = spark.createDataFrame([(t,) for t in titles], "page_title string")
    got = {(r.namespace, r.page_title) for r in cleaning.split_title(rows).collect()}
    assert got == {("File", "B:C"), ("Talk", ""), ("Article", "noc"), ("User talk", "Z"), ("Talk", "é:ß")}
    assert ("User talk", "Z") in got
    loose = cleaning.split_title(rows, normalize_underscores=True)
    assert loose.where("namespace = 'User talk'").count() == 2


def test_quality(spark):
    rows = spark.createDataFrame(
        [
            ("en", "A", 0, 1),
            ("en", "A", 1_000_000_000, 1),
            ("en", "A", 1_000_000_001, 1),
            ("en", "A", -1, 1),
            ("en", "A", None, 1),
            (None, "A", 1, 1),
            ("en", None, 1, 1),
            ("en", "-", 1, 1),
        ],
        LOG,
    )
    assert cleaning.quality_checks(rows).count() == 2
    assert cleaning.quality_report(rows).first().asDict() == {
        "n_rows": 8,
        "failed_views_in_range": 3,
        "failed_domain_present": 1,
        "failed_title_present": 1,
        "failed_title_not_placeholder": 1,
        "n_kept": 2,
    }
    cleaned = cleaning.silver(rows)
    assert "total_response_size" not in cleaned.columns


def test_raw_lines(spark, tmp_path):
    lines = ['en "Heroes" 2 0', 'en "Open 7 0', 'en "" 1 0', "fr X bad 0", "it Y 4", "en a\\b 1 1", "en #c 1 1"]
    (tmp_path / "pageviews-20250101-130000.gz").write_bytes(__import__("gzip").compress("\n".join(lines).encode()))
    (tmp_path / "projectviews-20250101-130000.gz").write_bytes(__import__("gzip").compress(b"en Z 1 1"))
    (tmp_path / "pageviews-latest").write_text("en Z 1 1")
    expected = {
        ("en", '"Heroes"', 2, 0),
        ("en", '"Open', 7, 0),
        ("en", '""', 1, 0),
        ("fr", "X", None, 0),
        ("it", "Y", 4, None),
        ("en", "a\\b", 1, 1),
        ("en", "#c", 1, 1),
    }
    rows = raw.read_raw(spark, str(tmp_path))
    assert {tuple(r)[:4] for r in rows.collect()} == expected
    assert {tuple(r)[4:] for r in rows.collect()} == {(day("2025-01-01"), "13:00:00")}
    parsed = raw.parse_lines(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert {tuple(r) for r in parsed.collect()} == expected
    assert not spark.createDataFrame([("pageviews-20251301-000000.gz",)], "source_file string").select(
        raw.file_timestamp(F.col("source_file"))
    ).first()[0]


def test_dates(spark):
    texts = spark.createDataFrame([("20241230",), ("2024-12-30",), ("nonsense",)], "file_date string")
    got = [r[0] for r in texts.select(E.as_date(texts, "file_date")).collect()]
    assert got == [day("2024-12-30"), day("2024-12-30"), None]
    days = spark.createDataFrame([(day("2024-12-30"),), (day("2027-01-01"),), (day("2021-01-03"),)], "d date")
    assert [r[0] for r in days.select(E.iso_week(F.col("d"))).collect()] == ["2025-01", "2026-53", "2020-53"]
    spine = profiles.weekend_spine(spark, day("2025-01-03"), day("2025-01-06")).collect()
    assert [r.is_weekend for r in spine] == [False, True, True, False]


VIEWS = "file_date date, language string, database_name string, page_title string, count_views bigint"


def test_zero_totals(spark):
    rows = spark.createDataFrame(
        [(day("2025-01-01"), "English", "wikipedia.org", p, 0) for p in "ab"]
        + [(day("2025-01-02"), "English", "wikipedia.org", p, v) for p, v in (("a", 3), ("b", 1), ("c", 0))],
        VIEWS,
    )
    index = {r.dt.day: r.diversity_index for r in kpis.diversity(rows).collect()}
    assert index == {1: None, 2: 0.75}
    entropy = {r.dt.day: r.shannon_entropy for r in kpis.shannon_entropy(rows).collect()}
    assert entropy[1] == 0.0
    assert entropy[2] == pytest.approx(-(0.75 * math.log(0.75) + 0.25 * math.log(0.25)))
    shares = {r.dt.day: (r.top1_views, r.top1_share) for r in kpis.top_n_share(rows, (1,)).collect()}
    assert shares == {1: (0, None), 2: (3, 0.75)}


def test_stickiness_forms_agree(spark):
    days = [day("2025-01-31"), day("2025-02-01"), day("2025-02-28"), day("2024-02-29")]
    rows = spark.createDataFrame(
        [(d, lang, "wikipedia.org", f"p{i}", 1) for i in range(6) for n, d in enumerate(days) for lang in ("a", "b") if i % (n + 1) == 0]
        + [(days[0], "c", "wikipedia.org", None, 1)],
        VIEWS,
    )
    joined = kpis.stickiness(kpis.dau(rows, kpis.PROJECT), kpis.mau(rows))
    once = kpis.stickiness_from_views(rows).select(*joined.columns)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_approximate_and_weekly(spark):
    rows = spark.createDataFrame([(day("2024-12-30"), "a", "p", f"t{i}", 1) for i in range(20)], VIEWS)
    assert kpis.dau(rows, approx=0.05).first().DAU == pytest.approx(20, abs=2)
    assert kpis.wau(rows).first().week == "2025-01"


KEYED = "file_date date, k string, file_time string, domain_code string, count_views bigint"
WINDOWS = ("2025-01-01", "2025-01-09", "2025-01-10", "2025-01-12")


def keyed(spark, rows):
    return spark.createDataFrame([(day(f"2025-01-{d:02d}"), k, t, c, v) for d, k, t, c, v in rows], KEYED)


def test_entity_rules(spark):
    rows = keyed(
        spark,
        [
            (1, "gaps", "00:00:00", "en", 1),
            (5, "gaps", "00:00:00", "en", 2),
            (9, "gaps", "00:00:00", "en", 4),
            (8, "day_before", "01:00:00", "en.m", 5),
            (8, "day_before", "01:00:00", "en", 5),
            (10, "day_before", "00:00:00", "en", 1),
            (11, "later_only", "00:00:00", "en", 1),
            (3, "zero", "00:00:00", "en", 0),
            (3, None, "00:00:00", "en", 1),
        ],
    )
    got = {r.k: r for r in churn_dataset(rows, *WINDOWS, key_cols=["k"], features="full").collect()}
    assert set(got) == {"gaps", "day_before", "zero"}
    gaps, before, zero = got["gaps"], got["day_before"], got["zero"]
    assert (gaps.sum_3d, gaps.sum_7d, gaps.views_last_day, gaps.churn) == (7, 7, 4, 1)
    assert gaps.trend_slope == pytest.approx(0.375) and gaps.views_median == 2 and gaps.first_dow == 4
    assert (before.views_last_day, before.sum_3d, before.churn) == (0, 0, 0)
    assert before.trend_slope is None and before.views_std == 0.0
    assert before.n_domains == 2 and before.views_entropy_norm == pytest.approx(1.0)
    assert before.domain_code == "en.m"
    assert zero.is_zero_history and zero.views_entropy == 0.0 and zero.is_sparse
    by_days = churn_dataset(rows, *WINDOWS, key_cols=["k"], frame="days")
    assert {r.k: r.sum_3d for r in by_days.collect()} == {"gaps": 4, "day_before": 0, "zero": 0}


def test_median_is_discrete(spark):
    rows = keyed(spark, [(d, "x", "00:00:00", "en", d) for d in range(1, 11)])
    daily = features.daily_views(rows, ["k"])
    assert features.entity_features(daily, ["k"], "full", "2025-01-01").first().views_median == 5


def test_sparsity_bounds(spark):
    days = spark.createDataFrame([(n,) for n in (1, 2, 3, 5, 6, 8, 9)], "n bigint")
    got = [r[0] for r in days.select(E.sparsity_level(F.col("n"))).collect()]
    assert got == ["very_sparse", "very_sparse", "sparse", "sparse", "medium", "medium", "frequent"]


def test_windows_are_checked(spark):
    with pytest.raises(ValueError):
        features.Windows.of("2025-01-01", "2025-01-10", "2025-01-10", "2025-01-12")
    rows = keyed(spark, [(1, "a", "00:00:00", "en", 1)])
    train = features.Windows.of("2025-01-01", "2025-01-03", "2025-01-04", "2025-01-05")
    test = features.Windows.of("2025-01-03", "2025-01-06", "2025-01-07", "2025-01-08")
    with pytest.warns(UserWarning):
        train_test_sets(rows, train, test, ["k"])


def test_links(spark):
    html = """<A class="x" HREF = '/a&amp;b.gz'>x</A><a name="y">no</a><a
      href="/c.gz">c</a><area href="/d.gz"><a data-href="/e.gz">e</a>"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    links = landing.link_harvest(pages, "/", ".gz")
    assert {r.link for r in links.collect()} == {"/a&b.gz", "/c.gz"}
    landed = spark.createDataFrame([("/c.gz",)], "link string")
    assert [r.link for r in landing.pending_files(links, landed).collect()] == ["/a&b.gz"]
