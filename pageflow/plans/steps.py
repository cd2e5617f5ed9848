"""The jobs of the pipeline, from landed files to an evaluated model; every path is an argument."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import ENTITY_KEYS, SEARCH_ROWS, SEARCH_SPACE
from pageflow.functions.running import materialize
from pageflow.operators import kpis, modeling, sampling
from pageflow.operators.cleaning import silver
from pageflow.operators.features import Windows
from pageflow.plans.churn import CORE_SCHEMA, SET_NAME, train_test_sets
from pageflow.sources.raw import read_raw
from pageflow.sources.tables import read_table, require_paths, split_by_language, write_table


def bronze_step(spark: SparkSession, input_dir: str, bronze_path: str) -> DataFrame:
    """Landed log files to the bronze table."""
    write_table(read_raw(spark, input_dir), bronze_path)
    return read_table(spark, bronze_path)


def silver_step(spark: SparkSession, bronze_path: str, silver_path: str) -> DataFrame:
    """Bronze to cleaned page views."""
    require_paths(spark, bronze_path)
    write_table(silver(read_table(spark, bronze_path)), silver_path)
    return read_table(spark, silver_path)


def gold_step(
    spark: SparkSession,
    silver_path: str,
    languages_path: str,
    set_paths: Mapping[str, str],
    train: Windows,
    test: Windows,
    language: str | None = "Italian",
    languages: Sequence[str] = ("English", "Italian", "French", "German", "Spanish"),
) -> dict[str, DataFrame]:
    """Per-language tables, and the train and test sets of one language (None: of all) from one pass over it."""
    require_paths(spark, silver_path)
    views = read_table(spark, silver_path)
    by_language = split_by_language(views, languages, languages_path)
    chosen = views if language is None else by_language[language]
    # Stored once, as each of the two tables is written from it.
    both = materialize(train_test_sets(chosen, train, test))
    for name, path in set_paths.items():
        rows = both.where(F.col(SET_NAME) == name).drop(SET_NAME)
        write_table(rows, path, partition_by="days_active")
    return {name: read_table(spark, path, CORE_SCHEMA) for name, path in set_paths.items()}


def kpi_step(spark: SparkSession, silver_path: str, fraction: float = 1.0) -> dict[str, DataFrame]:
    """DAU shares, one language against the rest, and stickiness in percent, on a sample or in full.

    A sample takes whole pages, which keeps DAU and MAU of the pages in it consistent.
    """
    views = read_table(spark, silver_path)
    if fraction < 1:
        views = sampling.sample_fraction(views, fraction, ENTITY_KEYS)
    shares = kpis.dau_share(views)
    return {
        "dau_share": shares,
        "one_vs_rest": kpis.one_vs_rest(shares),
        "stickiness_pct": kpis.stickiness_from_views(views, by=("language",), scale=100),
    }


def train_step(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    space: Mapping[str, Sequence] = SEARCH_SPACE,
    search_rows: int = SEARCH_ROWS,
) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Search and fit on the train split, metrics on all held-out rows and on the whole later set, importances.

    The search compares settings on ``search_rows`` labelled rows; the best ones are fitted on the whole split.
    """
    require_paths(spark, train_path, test_path)
    split = sampling.stratified_split(read_table(spark, train_path, CORE_SCHEMA), "churn", ENTITY_KEYS)
    fit_rows, held_out = [modeling.model_input(part) for part in sampling.split_parts(split)]
    later = modeling.model_input(read_table(spark, test_path, CORE_SCHEMA))
    fit_rows, held_out, later = modeling.with_rates(fit_rows, held_out, later)

    pipeline = modeling.pipeline_for(fit_rows)
    search = modeling.hyperparameter_search(pipeline, sampling.sample_n(fit_rows, search_rows, ENTITY_KEYS), space=space)
    best = max(range(len(search.avgMetrics)), key=search.avgMetrics.__getitem__)
    model = pipeline.fit(fit_rows, search.getEstimatorParamMaps()[best])

    results = {"search": modeling.search_results(spark, search)}
    for name, rows in (("hold_out", held_out), ("external", later)):
        for part, table in modeling.evaluate_model(model, rows, name).items():
            results[f"{name}_{part}"] = table
    results["importance"] = modeling.permutation_importance(model, held_out)
    return model, results
