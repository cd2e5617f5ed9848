"""Out-of-fold rates of levels: against plain Python, and that no label leaks into its own rate."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pageflow.operators import encoding, modeling

SCHEMA = "id int, title string, churn int"


def folds_of(rows):
    return [int(hashlib.md5(f"{r[0]}|42".encode()).hexdigest()[:8], 16) % 5 for r in rows]


def rates_by_hand(rows, strength=20.0):
    folds, out = folds_of(rows), {}
    for (k, title, _), fold in zip(rows, folds):
        rest = [r for r, f in zip(rows, folds) if f != fold]
        mean = sum(r[2] for r in rest) / len(rest)
        own = [r[2] for r in rest if r[1] == title]
        out[k] = (sum(own) + strength * mean) / (len(own) + strength)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    titles = ["hot"] * 300 + [None] * 40 + [""] * 20 + [f"t{rng.randrange(200)}" for _ in range(500)]
    return [(k, t, int(rng.random() < (0.9 if t == "hot" else 0.3))) for k, t in enumerate(titles)]


def test_rates_equal_plain_python(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    later = spark.createDataFrame([(1, "hot"), (2, "never seen"), (3, None)], "id int, title string").withColumns({"_level": F.lit("x"), "_n": F.lit(1)})
    fitted, other = encoding.cross_fitted_rates(df.repartition(5), "title", "churn", ["id"], [later])
    assert fitted.columns == ["id", "title", "churn", "title_rate"] and other.columns == [*later.columns, "title_rate"]
    got, want = {r.id: r.title_rate for r in fitted.collect()}, rates_by_hand(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    mean = sum(r[2] for r in rows) / len(rows)
    own = {t: [r[2] for r in rows if r[1] == t] for t in ("hot", "never seen", None)}
    for r in other.collect():
        assert r.title_rate == pytest.approx((sum(own[r.title]) + 20 * mean) / (len(own[r.title]) + 20), rel=1e-12)


def test_no_label_reaches_its_own_rate(spark, rows):
    """Turning all labels of one fold around changes the rates of the other folds only."""
    folds = folds_of(rows)
    turned = [(k, t, 1 - c if f == 3 else c) for (k, t, c), f in zip(rows, folds)]
    one, two = ({r.id: r.title_rate for r in encoding.cross_fitted_rates(spark.createDataFrame(x, SCHEMA), "title", "churn", ["id"])[0].collect()} for x in (rows, turned))
    for (k, _, _), fold in zip(rows, folds):
        assert (one[k] == two[k]) == (fold == 3)


def test_titles_that_occur_once_teach_nothing(spark):
    """With one row per title the in-sample mean would be the label itself; the out-of-fold rate is no better than chance."""
    rng = random.Random(9)
    df = spark.createDataFrame([(k, f"t{k}", rng.randrange(2)) for k in range(2_000)], SCHEMA)
    fitted = encoding.cross_fitted_rates(df, "title", "churn", ["id"])[0]
    assert abs(fitted.corr("title_rate", "churn")) < 0.1


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    fitted, other = encoding.cross_fitted_rates(empty, "title", "churn", ["id"], [spark.createDataFrame([(1, "a", 1)], SCHEMA)])
    assert fitted.count() == 0 and other.first().title_rate is None
    single = encoding.cross_fitted_rates(spark.createDataFrame([(1, "a", 1)], SCHEMA), "title", "churn", ["id"])[0]
    assert single.first().title_rate is None


def test_the_pipeline_takes_the_rate_instead_of_hashed_titles(spark, rows):
    df = modeling.model_input(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("title", "page_title"))
    rated = modeling.with_rates(df, key_cols=["id"])[0]
    stages = modeling.pipeline_for(rated, maxIter=1).getStages()
    assert not any("Hasher" in type(s).__name__ for s in stages)
    model = modeling.pipeline_for(rated, maxIter=3, maxDepth=3).fit(rated)
    assert model.transform(rated).count() == len(rows)
