"""Preparation, search, prediction and importance on a small learnable set."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pageflow.operators import modeling


@pytest.fixture(scope="module")
def data(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("page_title"),
        F.when(F.col("id") % 2 == 0, "English").otherwise("Italian").alias("language"),
        (F.col("id") % 4 == 0).alias("is_mobile"),
        (F.col("id") % 10).alias("days_active"),
        (F.abs(F.hash("id")) % 7).cast("double").alias("noise"),
        (F.col("id") % 10 < 5).cast("int").alias("churn"),
    )
    return rows.repartition(4).cache()


@pytest.fixture(scope="module")
def model(data):
    rows = modeling.model_input(data)
    return modeling.pipeline_for(rows, maxIter=3, maxDepth=2).fit(rows)


def test_roles(data):
    assert modeling.column_roles(data) == (["page_title", "language", "is_mobile"], ["days_active", "noise"])


@pytest.mark.parametrize("size", ["0.001", "0.01", "0.1"])
def test_stages_do_not_depend_on_the_rows(spark, data, size):
    """Titles are hashed whether there are few or very many."""
    rows = modeling.model_input(data.limit(int(float(size) * 400) + 1))
    stages = modeling.pipeline_for(rows).getStages()
    assert [type(s).__name__ for s in stages] == [
        "StringIndexer", "OneHotEncoder", "FeatureHasher", "VectorAssembler", "StandardScaler", "VectorAssembler", "GBTClassifier"
    ]
    assert stages[2].getInputCols() == ["page_title"]


def test_unknown_level_is_zero(spark, data):
    stages = modeling.build_preprocessor(["language"], ["days_active"])
    fitted = Pipeline(stages=stages).fit(modeling.model_input(data))
    row = spark.createDataFrame([("Klingon", 4.5)], "language string, days_active double")
    values = fitted.transform(row).select(vector_to_array("features")).first()[0]
    assert values == pytest.approx([0.0, 0.0, 0.0])


def test_standardize(data):
    got = modeling.standardize(data.withColumn("same", F.lit(3)), ["days_active", "same"])
    row = got.agg(F.avg("days_active"), F.stddev_pop("days_active"), F.max("same")).first()
    assert tuple(row) == pytest.approx((0.0, 1.0, 0.0))


def test_predictions_and_evaluation(model, data):
    rows = modeling.model_input(data)
    scored = modeling.predict(model, rows)
    assert scored.where("score < 0 or score > 1 or prediction not in (0, 1)").isEmpty()
    parts = modeling.evaluate_model(model, rows, "all")
    ranking = {r.ranked_by: r for r in parts["ranking"].collect()}
    assert ranking["score"].roc_auc == pytest.approx(1.0) and set(ranking) == {"score", "prediction"}
    assert {r["class"] for r in parts["report"].collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def test_permuted_copies_move_one_feature_only(data):
    rows = modeling.model_input(data)
    features = ["days_active", "language"]
    kept = rows.select("page_title", "churn", *features)
    copies = modeling.permuted_copies(kept, features, ["page_title"], 2, 42, 4).collect()
    assert len(copies) == 400 * 2 * 2
    original = {r.page_title: r for r in kept.collect()}
    for feature, other in (features, features[::-1]):
        for repeat in (1, 2):
            mine = [r for r in copies if r.feature == feature and r.repeat == repeat]
            assert all(r[other] == original[r.page_title][other] for r in mine)
            assert Counter(r[feature] for r in mine) == Counter(r[feature] for r in original.values())
            assert sum(r[feature] != original[r.page_title][feature] for r in mine) > 100


def test_importance_finds_the_cause(model, data):
    rows = modeling.model_input(data)
    top = modeling.permutation_importance(model, rows, ["page_title"], repeats=2).collect()
    assert top[0].feature == "days_active" and top[0].importance_mean > 0.2
    assert {r.feature for r in top} == set(rows.columns) - {"churn"}
    assert modeling.permutation_importance(model, rows, ["page_title"], repeats=1, top=1).count() == 1


def test_draws():
    draws = modeling.draw_params()
    assert len(draws) == 2 and draws == modeling.draw_params() and draws != modeling.draw_params(seed=1)
    assert modeling.tree_settings({"max_depth": 10})["maxDepth"] == 10
    with pytest.raises(ValueError):
        modeling.tree_settings({"max_depth": None})
