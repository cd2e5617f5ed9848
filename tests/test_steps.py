"""The whole pipeline, from landed files to importances."""

import pytest

from pageflow.functions.fixed_values import ENTITY_KEYS
from pageflow.functions.running import scratch_path
from pageflow.operators import sampling
from pageflow.plans import steps
from pageflow.plans.fixtures import SILVER_COLUMNS, TEST, TRAIN, land_raw_files, log_lines, page_log
from pageflow.sources.tables import path_exists

TINY_SPACE = {"max_depth": [2, 3], "learning_rate": [0.1], "max_iter": [2], "min_samples_leaf": [5]}


def test_pipeline(spark):
    landed = land_raw_files(spark, log_lines(page_log(spark, "/root/testdata/sf0.001")))
    paths = {name: scratch_path(spark, name) for name in ("bronze", "silver", "languages", "train", "test")}
    assert steps.bronze_step(spark, landed, paths["bronze"]).count() == 1000
    views = steps.silver_step(spark, paths["bronze"], paths["silver"])
    assert set(views.columns) == set(SILVER_COLUMNS) and views.count() > 0

    set_paths = {name: paths[name] for name in ("train", "test")}
    with pytest.warns(UserWarning):
        sets = steps.gold_step(spark, paths["silver"], paths["languages"], set_paths, TRAIN, TEST, language="English")
    assert all(df.count() > 20 and df.where("language <> 'English'").isEmpty() for df in sets.values())
    assert path_exists(spark, paths["languages"] + "/language=Italian")

    shares = steps.kpi_step(spark, paths["silver"])
    assert {"dau_share", "one_vs_rest", "stickiness_pct"} == set(shares)
    assert abs(shares["one_vs_rest"].groupBy("file_date").sum("DAU_pct").first()[1] - 100) < 1e-9
    part = steps.kpi_step(spark, paths["silver"], 0.5)["stickiness_pct"]
    assert part.where("stickiness > 100").isEmpty()

    model, results = steps.train_step(spark, paths["train"], paths["test"], space=TINY_SPACE)
    assert {"search", "hold_out_ranking", "hold_out_report", "external_ranking", "external_report", "importance"} == set(results)
    assert results["search"].count() == 2 and results["importance"].count() == len(sets["train"].columns) - 1
    split = sampling.stratified_split(sets["train"], "churn", ENTITY_KEYS)
    support = {n: results[f"{n}_report"].where("class = 'accuracy'").first().support for n in ("hold_out", "external")}
    assert support == {"hold_out": split.where("is_test").count(), "external": sets["test"].count()}
    with pytest.raises(FileNotFoundError):
        steps.train_step(spark, paths["train"], "/tmp/nowhere")
