"""Relations that must hold between results, and brute-force checks with one hot group."""

from __future__ import annotations

import datetime
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import ENTITY_KEYS
from pageflow.functions.hashing import hash_rank
from pageflow.functions.running import running_totals
from pageflow.operators import explore, features, kpis, maintenance, metrics, sampling
from pageflow.plans.churn import churn_dataset, churn_datasets
from pageflow.plans.fixtures import TEST, TRAIN, silver_log

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark):
    return silver_log(spark, SF_DIR).cache()


def args(w):
    return w.obs_start, w.obs_end, w.lbl_start, w.lbl_end


def rows(df, *columns):
    return Counter(map(repr, map(tuple, df.select(*(columns or sorted(df.columns))).collect())))


def rounded_rows(df):
    keep = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
    return rows(df.select(*keep))


@pytest.mark.parametrize("kind", ["core", "full"])
def test_one_plan_equals_steps_joined(log, kind):
    daily = features.daily_views(features.observation_rows(log, TRAIN))
    sums = (3, 7) if kind == "full" else (3,)
    parts = features.entity_features(daily, features=kind, obs_start=TRAIN.obs_start)
    last = features.last_day_snapshot(daily, TRAIN.obs_end, sums=sums)
    stepwise = parts.join(last, ENTITY_KEYS, "left").fillna(0, ["views_last_day", *[f"sum_{n}d" for n in sums]])
    stepwise = stepwise.join(features.churn_labels(log, TRAIN), ENTITY_KEYS)
    if kind == "full":
        observed = features.observation_rows(log, TRAIN)
        stepwise = stepwise.join(features.domain_entropy(observed), ENTITY_KEYS, "left")
        stepwise = stepwise.join(features.last_domain(observed), ENTITY_KEYS, "left")
    fused = churn_dataset(log, *args(TRAIN), features=kind)
    assert rounded_rows(fused.select(*stepwise.columns)) == rounded_rows(stepwise)


def test_two_sets_equal_each_alone(log):
    both = churn_datasets(log, {"train": TRAIN, "test": TEST}, features="full")
    for name, windows in (("train", TRAIN), ("test", TEST)):
        alone = churn_dataset(log, *args(windows), features="full")
        assert rounded_rows(both.where(F.col("set_name") == name).drop("set_name")) == rounded_rows(alone)


def test_features_do_not_see_other_days(log):
    outside = F.col("file_date") > F.lit(TRAIN.obs_end)
    changed = log.withColumn("count_views", F.when(outside, F.lit(99)).otherwise(F.col("count_views"))).where(
        ~outside | (F.col("language") != "English")
    )
    before, after = churn_dataset(log, *args(TRAIN)), churn_dataset(changed, *args(TRAIN))
    assert rounded_rows(before.drop("churn")) == rounded_rows(after.drop("churn"))


def test_churned_are_those_not_seen_again(log):
    seen = features.observation_rows(log, TRAIN).select(*ENTITY_KEYS).distinct()
    later = features.label_rows(log, TRAIN).select(*ENTITY_KEYS).distinct()
    churned = churn_dataset(log, *args(TRAIN)).where("churn = 1")
    assert churned.count() == seen.join(later, ENTITY_KEYS, "left_anti").count()


def test_measures_are_bounded(log):
    assert kpis.stickiness_from_views(log).where("stickiness > 1 or DAU > MAU").isEmpty()
    top = kpis.top_n_share(log, (2, 5))
    assert top.where("top2_views > top5_views or top5_views > total_views").isEmpty()
    pages = kpis.diversity(log).select("dt", *kpis.PROJECT, "distinct_pages")
    entropy = kpis.shannon_entropy(log).join(pages, ["dt", *kpis.PROJECT])
    assert entropy.where("shannon_entropy < 0 or shannon_entropy > ln(distinct_pages) + 1e-9").isEmpty()


@pytest.fixture(scope="module")
def hot(spark):
    """4,000 values in 30 groups; one group holds a third of them, and one value a third of that."""
    draw = random.Random(7)
    data = []
    for i in range(4000):
        group = "hot" if draw.random() < 1 / 3 else f"g{draw.randrange(29)}"
        value = 1 if draw.random() < 1 / 3 else draw.randrange(500)
        data.append((group, f"t{i:05d}", value))
    return data, spark.createDataFrame(data, "g string, t string, v bigint").repartition(8).cache()


def test_running_totals(hot):
    data, df = hot
    got = running_totals(df, [F.desc("v"), "t"], {"place": F.lit(1), "total": "v"}, ["g"])
    assert got.columns == ["g", "t", "v", "place", "total"]
    expected, count, total = {}, defaultdict(int), defaultdict(int)
    for g, t, v in sorted(data, key=lambda r: (r[0], -r[2], r[1])):
        count[g] += 1
        total[g] += v
        expected[t] = (count[g], total[g])
    assert {r.t: (r.place, r.total) for r in got.collect()} == expected
    whole = running_totals(df, ["t"], {"place": F.lit(1)})
    assert [r.place for r in whole.orderBy("t").select("place").collect()] == list(range(1, 4001))


def test_hash_rank(hot):
    _, df = hot
    got = hash_rank(df, ["t"], 42, ["g"])
    plain = Window.partitionBy("g").orderBy(F.md5(F.concat_ws("|", "t", F.lit("42"))))
    assert got.withColumn("want", F.row_number().over(plain)).where("want <> hash_rank").isEmpty()
    assert got.groupBy("g", "hash_rows").count().where("count <> hash_rows").isEmpty()


def test_page_ranks_with_a_hot_group(hot):
    data, df = hot
    pages = df.select(
        F.lit(datetime.date(2025, 1, 1)).alias("file_date"),
        F.col("g").alias("language"),
        F.lit("p").alias("database_name"),
        F.col("t").alias("page_title"),
        F.col("v").alias("count_views"),
    )
    ranks = {r.page_title: r["rank"] for r in kpis.page_rank(pages).collect()}
    groups = defaultdict(list)
    for g, t, v in data:
        groups[g].append((-v, t))
    expected = {t: i for members in groups.values() for i, (_, t) in enumerate(sorted(members), 1)}
    assert ranks == expected
    top = kpis.page_rank(pages, 5)
    assert {r.page_title: r["rank"] for r in top.collect()} == {t: n for t, n in expected.items() if n <= 5}
    shares = {r.language: (r.top3_views, r.total_views) for r in kpis.top_n_share(pages, (3,)).collect()}
    assert shares == {
        g: (-sum(v for v, _ in sorted(m)[:3]), -sum(v for v, _ in m)) for g, m in groups.items()
    }


def test_box_statistics(hot):
    data, df = hot
    named = df.select(F.when(F.col("g") == "hot", 1).otherwise(0).alias("churn"), F.col("v").alias("x"))
    got = {r.churn: r for r in explore.feature_box_stats(named, ["x"]).collect()}
    for churn in (0, 1):
        values = sorted(v for g, _, v in data if (g == "hot") == bool(churn))

        def quantile(p):
            at = p * (len(values) - 1)
            low = int(at)
            high = min(low + 1, len(values) - 1)
            return values[low] + (values[high] - values[low]) * (at - low)

        q1, q3 = quantile(0.25), quantile(0.75)
        row = got[churn]
        assert (row.q1, row.median, row.q3) == pytest.approx((q1, quantile(0.5), q3))
        assert row.whisker_low == min(v for v in values if v >= q1 - 1.5 * (q3 - q1))
        assert row.whisker_high == max(v for v in values if v <= q3 + 1.5 * (q3 - q1))


def test_ranking_metrics(spark):
    draw = random.Random(3)
    data = [(int(draw.random() < 0.4), draw.randrange(40) / 10) for _ in range(300)]
    scored = spark.createDataFrame(data, "label int, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap, recall = 0.0, 0.0
    for threshold in sorted({s for _, s in data}, reverse=True):
        tp, fp = sum(s >= threshold for s in pos), sum(s >= threshold for s in neg)
        ap += (tp / len(pos) - recall) * tp / (tp + fp)
        recall = tp / len(pos)
    got = metrics.ranking_metrics(scored).first()
    assert (got.roc_auc, got.average_precision) == pytest.approx((auc, ap))
    both = scored.withColumn("set", F.lit("a")).unionByName(scored.withColumn("set", F.lit("b")))
    for row in metrics.ranking_metrics(both, by=["set"]).collect():
        assert (row.roc_auc, row.average_precision) == pytest.approx((auc, ap))
    assert metrics.roc_auc(scored.where("label = 1")).first()[0] is None


def test_report_of_a_class_never_predicted(spark):
    scored = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "label int, prediction int")
    report = {r["class"]: r for r in metrics.classification_report(scored).collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].support) == (0.0, 0.0, 1)
    assert report["accuracy"].f1 == pytest.approx(2 / 3)
    assert report["weighted avg"].support == 3


def test_samples_and_splits(hot):
    data, df = hot
    part = sampling.sample_fraction(df, 0.25, ["t"])
    assert 800 < part.count() < 1200
    assert rows(part) == rows(sampling.sample_fraction(df.repartition(3), 0.25, ["t"]))
    assert sampling.sample_fraction(df, 1.0, ["t"]).count() == 4000
    assert sampling.sample_n(df, 77, ["t"]).count() == 77
    labelled = df.withColumn("churn", (F.col("g") == "hot").cast("int"))
    for exact in (False, True):
        split = sampling.stratified_split(labelled, "churn", ["t"], exact=exact).cache()
        train, test = sampling.split_parts(split)
        assert train.count() + test.count() == 4000 and train.join(test, "t").isEmpty()
        for r in split.groupBy("churn").agg(F.avg(F.col("is_test").cast("double")).alias("share"), F.count("*").alias("n")).collect():
            assert abs(r.share - 0.2) <= (1 / r.n if exact else 0.05)


def test_dedup_with_many_copies(hot):
    data, df = hot
    newest = maintenance.dedup_latest(df.select("g", F.col("v").alias("ingestion_time"), "t"), ["g"])
    best = {}
    for g, t, v in data:
        best[g] = max(best.get(g, (-1, "")), (v, t))
    assert {r.g: (r.ingestion_time, r.t) for r in newest.collect()} == best
