"""Selection instead of sorting: box statistics, samples and exact splits of skewed classes against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageflow.functions import selection
from pageflow.operators import explore, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """70,000 rows, 90 % of one class; one feature continuous, one with few values, one with odd values."""
    rng = np.random.default_rng(1)
    n = 70_000
    classes = np.where(rng.random(n) < 0.9, 1, 0)
    rows = [
        (int(k), int(c), float(x), int(v), None if k % 3 == 0 else float("nan") if k % 3 == 1 else -float(v) * 1e-7)
        for k, c, x, v in zip(range(n), classes, np.exp(3 * rng.standard_normal(n)), rng.integers(0, 5, n))
    ]
    return rows, spark.createDataFrame(rows, "k long, churn int, x double, few int, odd double").repartition(6)


def plain_box(values):
    v = np.sort(np.array(values, float))
    q = []
    for p in (0.25, 0.5, 0.75):
        place = (len(v) - 1) * p
        low, high = v[math.floor(place)], v[math.ceil(place)]
        q.append(low + (high - low) * (place - math.floor(place)))
    reach = 1.5 * (q[2] - q[0])
    return (len(v), *q, v[v >= q[0] - reach].min(), v[v <= q[2] + reach].max())


def test_box_statistics_are_exact_beyond_the_sketch(skewed):
    rows, df = skewed
    got = {(r.feature, r.churn): tuple(r)[2:] for r in explore.feature_box_stats(df, ["x", "few", "odd"]).collect()}
    want = {}
    for at, feature in ((2, "x"), (3, "few"), (4, "odd")):
        for c in (0, 1):
            values = [r[at] for r in rows if r[1] == c and r[at] is not None and not math.isnan(r[at])]
            want[feature, c] = plain_box(values)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], rel=1e-12)


def test_few_values_are_kept_and_not_ordered(skewed):
    _, df = skewed
    part = df.select("churn", "x")
    kept = selection.bracketed_values(part, ["x"], ["churn"]).where("churn = 1")
    assert kept.where("kept").count() < 1_000
    assert kept.agg(F.sum("n")).first()[0] == df.where("churn = 1").count()
    plan = explore.feature_box_stats(df, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "rangepartitioning" not in plan and "Checkpoint" not in plan


def test_box_statistics_of_odd_tables(spark):
    schema = "churn int, x double"
    assert explore.feature_box_stats(spark.createDataFrame([], schema), ["x"]).count() == 0
    rows = [(None, 1.0), (None, 3.0), (0, 5.0), (1, None), (0, float("inf"))]
    got = {r.churn: tuple(r)[2:] for r in explore.feature_box_stats(spark.createDataFrame(rows, schema), ["x"]).collect()}
    assert set(got) == {None, 0} and got[None] == (2, 1.5, 2.0, 2.5, 1.0, 3.0)


def in_hash_order(keys, seed=42):
    return sorted(keys, key=lambda k: hashlib.md5(f"{k}|{seed}".encode()).hexdigest())


@pytest.mark.parametrize("n", [0, 1, 7, 30_000, 69_999, 70_000, 10**9])
def test_samples_of_any_size(skewed, n):
    rows, df = skewed
    got = sampling.sample_n(df, n, ["k"])
    assert sorted(r.k for r in got.select("k").collect()) == sorted(in_hash_order(range(len(rows)))[:n])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "TakeOrdered" not in plan


def test_split_of_a_class_with_most_rows(skewed):
    rows, df = skewed
    split = sampling.stratified_split(df, "churn", ["k"], test_share=0.3, exact=True)
    assert "Window" not in split._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r.is_test for r in split.collect()}
    for c in (0, 1):
        own = in_hash_order([r[0] for r in rows if r[1] == c])
        cut = math.ceil(len(own) * 0.3)
        assert all(got[k] for k in own[:cut]) and not any(got[k] for k in own[cut:])


def test_repeated_keys_and_odd_classes(spark):
    rng = random.Random(2)
    rows = [(None if rng.random() < 0.1 else rng.choice(["a", "b", "b", "b", ""]), rng.randrange(40)) for _ in range(5_000)] + [("c", 1)] * 3_000
    df = spark.createDataFrame(rows, "label string, k int")
    got = sampling.stratified_split(df, "label", ["k"], test_share=0.25, exact=True).collect()
    for label in {r[0] for r in rows}:
        own = [r for r in got if r.label == label]
        chosen = Counter(r.k for r in own if r.is_test)
        assert sum(chosen.values()) == math.ceil(0.25 * len(own))
        order = in_hash_order([r.k for r in own])
        assert chosen == Counter(order[: sum(chosen.values())])
    assert sampling.sample_n(df, 4_000, ["k"]).count() == 4_000
    assert sampling.stratified_split(df.limit(0), "label", ["k"], exact=True).count() == 0


def test_more_classes_than_a_map_may_hold(spark, monkeypatch):
    monkeypatch.setattr(selection, "MOST_CLASSES", 5)
    df = spark.range(100).selectExpr("id", "cast(id % 8 as int) as churn", "double(id) as x")
    with pytest.raises(ValueError):
        sampling.stratified_split(df, "churn", ["id"], exact=True)
    with pytest.raises(Exception, match="classes"):
        explore.feature_box_stats(df, ["x"]).collect()
