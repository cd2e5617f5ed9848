"""The registered queries: every operator over the whole tables of a scale factor directory.

Each callable takes (spark, sf_dir). Doubles are rounded to nine digits for comparison with the
SQL in ``pageflow.plans.oracle``; the operators themselves do not round.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pageflow.functions.fixed_values import ENTITY_KEYS, SEARCH_ROWS
from pageflow.functions.running import materialize, scratch_path
from pageflow.operators import cleaning, dailyuniques, explore, features, kpis, maintenance, metrics, modeling, profiles, sampling, topn
from pageflow.plans import churn, states
from pageflow.plans.fixtures import (
    LANGUAGES,
    LATE_DAY,
    RAW_COLUMNS,
    SILVER_COLUMNS,
    TEST,
    TRAIN,
    land_raw_files,
    log_lines,
    page_log,
    silver_log,
)
from pageflow.sources import landing, ledger, links, raw, tables

SECOND_BATCH = datetime.date(2024, 1, 16)  # from this day on, days are written by a later run
Query = Callable[[SparkSession, str], DataFrame]
# Few and shallow trees and a small search space, for time: the operators' defaults (100 to 500 rounds)
# take minutes on the smallest tables. They fit all train rows; the search takes SEARCH_ROWS labelled ones.
SMALL_TREES = {"maxIter": 5, "maxDepth": 3}
SMALL_SPACE = {
    "max_depth": [3, 4],
    "learning_rate": [0.05, 0.1, 0.2],
    "max_iter": [3, 5],
    "min_samples_leaf": [10, 20, 50],
}


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in doubles}) if doubles else df


# ---- sources and sinks


def bronze_ingest(spark, sf_dir):
    folder = land_raw_files(spark, log_lines(page_log(spark, sf_dir)))
    return raw.read_raw(spark, folder).select(*RAW_COLUMNS)


def bronze_parse_lines(spark, sf_dir):
    lines = log_lines(page_log(spark, sf_dir))
    return raw.add_file_time(raw.parse_lines(lines)).select(*RAW_COLUMNS)


def _named(spark, sf_dir):
    """Log rows under hourly file names; rows with few views sit in files of another kind."""
    log = page_log(spark, sf_dir)
    stamp = F.concat(F.date_format("file_date", "yyyyMMdd"), F.lit("-"), F.replace("file_time", F.lit(":")))
    kind = F.when(F.col("count_views") < 10, "projectviews-").otherwise("pageviews-")
    return log.select(F.concat(kind, stamp).alias("source_file"), "count_views")


def bronze_file_filter(spark, sf_dir):
    rows = _named(spark, sf_dir)
    return rows.where(raw.is_log_file(F.col("source_file"))).groupBy("source_file").agg(F.count("*").alias("n_rows"))


def bronze_file_timestamp(spark, sf_dir):
    return (
        raw.add_file_time(_named(spark, sf_dir))
        .groupBy("file_date", "file_time")
        .agg(F.count("*").alias("n_rows"), F.sum("count_views").alias("views"))
    )


def table_roundtrip(spark, sf_dir):
    rows, path = silver_log(spark, sf_dir), scratch_path(spark, "silver")
    tables.write_table(rows, path)
    return tables.read_table(spark, path, rows.schema)


def max_records_per_file(spark, sf_dir):
    path, limit = scratch_path(spark, "capped"), 100
    tables.write_table(silver_log(spark, sf_dir), path, max_records=limit)
    per_file = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), (F.max("n") <= limit).alias("within_limit"))


def gold_partitioned_roundtrip(spark, sf_dir):
    return rounded(_gold(spark, sf_dir))


def language_split(spark, sf_dir):
    parts = tables.split_by_language(silver_log(spark, sf_dir), LANGUAGES, scratch_path(spark, "languages"))
    first, *others = parts.values()
    for part in others:
        first = first.unionByName(part)
    return first


def _links(spark, sf_dir):
    return landing.link_harvest(spark.read.parquet(f"{sf_dir}/pages.parquet"), "/", "e")


def link_harvest(spark, sf_dir):
    return _links(spark, sf_dir)


def link_addresses(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return links.anchors(pages.select("page_id", "url", "html"), url="url").select("page_id", "link", "address")


def pending_files(spark, sf_dir):
    found = _links(spark, sf_dir)
    return landing.pending_files(found, found.where(F.col("url").contains("/en/")))


def landing_inventory(spark, sf_dir):
    folder = land_raw_files(spark, log_lines(page_log(spark, sf_dir)))
    hours = landing.landing_inventory(spark, folder).withColumn("hour", F.substring("file_name", 1, 25))
    per_hour = hours.groupBy("hour").agg(F.sum("file_bytes").alias("file_bytes"))
    totals = landing.landing_totals(per_hour)
    return totals.select("n_files", (F.col("total_bytes") > 0).alias("has_bytes"))


def set_row_counts(spark, sf_dir):
    rows = silver_log(spark, sf_dir)
    return tables.set_row_counts(train=features.churn_labels(rows, TRAIN), test=features.churn_labels(rows, TEST))


# ---- cleaning


def quality_checks(spark, sf_dir):
    return cleaning.quality_checks(page_log(spark, sf_dir)).select(*RAW_COLUMNS)


def quality_report(spark, sf_dir):
    return cleaning.quality_report(page_log(spark, sf_dir))


def domain_special_filter(spark, sf_dir):
    return cleaning.drop_special_domains(page_log(spark, sf_dir)).select("domain_code", "page_title", "count_views")


def _per_domain(column: str, language_map: bool = False, checked: bool = True) -> Query:
    def query(spark, sf_dir):
        log = page_log(spark, sf_dir)
        rows = cleaning.derive_domain(cleaning.quality_checks(log) if checked else log, language_map)
        return rows.groupBy("domain_code", column).agg(F.count("*").alias("n_rows"))

    return query


def title_namespace(spark, sf_dir):
    rows = cleaning.split_title(cleaning.quality_checks(page_log(spark, sf_dir)))
    return rows.groupBy("namespace", "page_title").agg(F.count("*").alias("n_rows"), F.sum("count_views").alias("views"))


# ---- measures


def stickiness(spark, sf_dir):
    rows = silver_log(spark, sf_dir)
    return rounded(kpis.stickiness(kpis.dau(rows, kpis.PROJECT), kpis.mau(rows)))


def stickiness_pct(spark, sf_dir):
    rows, by = silver_log(spark, sf_dir), ("language",)
    return rounded(kpis.stickiness(kpis.dau(rows, by), kpis.mau(rows, by), by, how="left", scale=100))


def _daily_bitmaps(spark, sf_dir) -> DataFrame:
    """The days' bitmaps as a table that two batches of days were written to, the second with new pages."""
    rows, path = silver_log(spark, sf_dir), scratch_path(spark, "bitmaps")
    numbers = None
    for batch in (F.col("file_date") < F.lit(SECOND_BATCH), F.col("file_date") >= F.lit(SECOND_BATCH)):
        part = rows.where(batch)
        numbers = dailyuniques.page_numbers(part, numbers)
        dailyuniques.update_days(dailyuniques.daily_bitmaps(part, numbers), path)
    return tables.read_table(spark, path)


def stickiness_bitmaps(spark, sf_dir):
    return rounded(dailyuniques.stickiness_of_bitmaps(_daily_bitmaps(spark, sf_dir)))


def wau_bitmaps(spark, sf_dir):
    return dailyuniques.uniques_of_bitmaps(_daily_bitmaps(spark, sf_dir), "week", name="WAU")


def uniques_from_sketches(spark, sf_dir):
    """Estimates of days, weeks and months from a table of daily sketches, held against exact counts."""
    rows, path = silver_log(spark, sf_dir), scratch_path(spark, "sketches")
    for batch in (F.col("file_date") < F.lit(SECOND_BATCH), F.col("file_date") >= F.lit(SECOND_BATCH)):
        dailyuniques.update_days(dailyuniques.daily_sketches(rows.where(batch)), path)
    daily, found = tables.read_table(spark, path), []
    for period in ("day", "week", "month"):
        guess = dailyuniques.uniques_of_sketches(daily, period, name="estimate")
        exact = rows.groupBy(dailyuniques.period_label(period).alias(period), "language").agg(F.count_distinct("page_title").alias("n_pages"))
        error = F.abs(F.col("estimate") - F.col("n_pages"))
        within = error <= 4 * dailyuniques.relative_error() * F.col("n_pages") + 1
        both = guess.join(exact, [period, "language"])
        found.append(both.select(F.lit(period).alias("period"), F.col(period).alias("label"), "language", "n_pages", within.alias("within_error")))
    return found[0].unionByName(found[1]).unionByName(found[2])


def _of_silver(operator: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, sf_dir: rounded(operator(silver_log(spark, sf_dir), *args, **options))


def dau_share_one_vs_rest(spark, sf_dir):
    return rounded(kpis.one_vs_rest(kpis.dau_share(silver_log(spark, sf_dir))))


def hourly_profile_until(spark, sf_dir):
    return profiles.hourly_profile(profiles.until(silver_log(spark, sf_dir), datetime.date(2024, 1, 10)))


# ---- features


def obs_lbl_windows(spark, sf_dir):
    rows = silver_log(spark, sf_dir)
    windows = F.when(TRAIN.observed(F.col("file_date")), "observation").when(TRAIN.labelled(F.col("file_date")), "label")
    return (
        rows.where(TRAIN.observed(F.col("file_date")) | TRAIN.labelled(F.col("file_date")))
        .groupBy(windows.alias("window_name"))
        .agg(F.count("*").alias("n_rows"), F.sum("count_views").alias("views"))
    )


def _daily(spark, sf_dir):
    return features.daily_views(features.observation_rows(silver_log(spark, sf_dir), TRAIN))


def _rolling(n: int, frame: str = "rows") -> Query:
    return lambda spark, sf_dir: features.rolling_sum(features.daily_views(silver_log(spark, sf_dir)), n, frame=frame).drop("dow")


def last_day_snapshot(spark, sf_dir):
    return features.last_day_snapshot(_daily(spark, sf_dir), TRAIN.obs_end)


def entity_features_core(spark, sf_dir):
    return rounded(features.entity_features(_daily(spark, sf_dir)))


def entity_features_full(spark, sf_dir):
    return rounded(features.entity_features(_daily(spark, sf_dir), features="full", obs_start=TRAIN.obs_start))


def _churn(spark, sf_dir, kind: str = "core") -> DataFrame:
    rows = silver_log(spark, sf_dir)
    return churn.churn_dataset(rows, TRAIN.obs_start, TRAIN.obs_end, TRAIN.lbl_start, TRAIN.lbl_end, features=kind)


def _of_churn(operator: Callable[..., DataFrame], *args, kind: str = "core", **options) -> Query:
    return lambda spark, sf_dir: rounded(operator(_churn(spark, sf_dir, kind), *args, **options))


def train_test_sets(spark, sf_dir):
    return rounded(churn.train_test_sets(silver_log(spark, sf_dir), TRAIN, TEST))


def _of_states(spark, parts: list[DataFrame], windows, kind: str) -> DataFrame:
    """The sets from a table of entity days written from the first views, days of later views merged in."""
    name, path, buckets = f"states_{uuid.uuid4().hex}", scratch_path(spark, "states"), 8
    states.create_table(states.entity_days(parts[0]), name, path, buckets)
    for views in parts[1:]:
        late = states.entity_days(views)
        old = spark.table(name).join(late.select("file_date").distinct(), "file_date", "left_semi")
        both = materialize(states.merged(old.select(*late.columns), late))
        states.replace_days(both, name, buckets)
    result = materialize(rounded(states.churn_sets(spark, name, windows, features=kind)))
    spark.sql(f"drop table {name}")
    tables.drop_path(spark, path)
    return result


def train_test_sets_of_states(spark, sf_dir):
    return _of_states(spark, [silver_log(spark, sf_dir)], {"train": TRAIN, "test": TEST}, "core")


def churn_dataset_full_of_states(spark, sf_dir):
    views, evening = silver_log(spark, sf_dir), F.col("file_time") >= "18:00:00"
    return _of_states(spark, [views.where(~evening), views.where(evening)], {"train": TRAIN}, "full").drop("set_name")


# ---- tables and late data


def _stamped(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, F.date_format("ingestion_time", "yyyy-MM-dd HH:mm:ss").alias("ingestion_time"))


def dedup_latest(spark, sf_dir):
    keys = ["page_title", "domain_code", "namespace"]
    rows = cleaning.silver(page_log(spark, sf_dir)).select(*keys, "count_views", "ingestion_time")
    return _stamped(maintenance.dedup_latest(rows, keys), *keys, "count_views")


def late_upsert(spark, sf_dir):
    """The evening of one day has not arrived; its second half then comes in, corrected."""
    rows = cleaning.silver(page_log(spark, sf_dir)).select(*SILVER_COLUMNS, "ingestion_time")
    of_day = F.col("file_date") == F.lit(datetime.date.fromisoformat(LATE_DAY))
    path = scratch_path(spark, "upsert")
    tables.write_table(rows.where(~(of_day & (F.col("file_time") >= "18:00:00"))), path)
    late = rows.where(of_day & (F.col("file_time") >= "12:00:00")).withColumns(
        {"count_views": F.col("count_views") + 1, "ingestion_time": F.expr("ingestion_time + interval 1 day")}
    )
    keys = ["page_title", "domain_code", "namespace", "file_time"]
    maintenance.upsert_partition(spark, path, late, LATE_DAY, keys)
    return _stamped(tables.read_table(spark, path, rows.schema), *SILVER_COLUMNS)


def late_upsert_days(spark, sf_dir):
    """The evenings of every third day have not arrived; the second halves of these days then come in at once, corrected."""
    rows = cleaning.silver(page_log(spark, sf_dir)).select(*SILVER_COLUMNS, "ingestion_time")
    of_days = F.dayofmonth("file_date") % 3 == 0
    path = scratch_path(spark, "upsert")
    tables.write_table(rows.where(~(of_days & (F.col("file_time") >= "18:00:00"))), path)
    late = rows.where(of_days & (F.col("file_time") >= "12:00:00")).withColumns(
        {"count_views": F.col("count_views") + 1, "ingestion_time": F.expr("ingestion_time + interval 1 day")}
    )
    keys = ["page_title", "domain_code", "namespace", "file_time"]
    maintenance.upsert_late(spark, path, late, keys)
    return _stamped(tables.read_table(spark, path, rows.schema), *SILVER_COLUMNS)


def ledger_ingest(spark, sf_dir):
    """Files of the first half of the month land and are taken; all others land then, and a third run finds nothing."""
    log = page_log(spark, sf_dir)
    path, ledger_path = scratch_path(spark, "bronze"), scratch_path(spark, "ledger")
    for part in (F.col("file_date") < F.lit(SECOND_BATCH), F.col("file_date") >= F.lit(SECOND_BATCH)):
        folder = land_raw_files(spark, log_lines(log.where(part)))
        for _ in range(2):
            ledger.take_new_files(spark, folder, path, ledger_path)
    return ledger.committed_rows(spark, path, ledger_path).select(*RAW_COLUMNS)


def _clustered(*by: str) -> Query:
    def query(spark, sf_dir):
        rows = silver_log(spark, sf_dir)
        path, dest = scratch_path(spark, "silver"), scratch_path(spark, "clustered")
        tables.write_table(rows, path)
        maintenance.cluster_rewrite(spark, path, dest, by)
        return tables.read_table(spark, dest, rows.schema)

    return query


# ---- sampling, metrics, models

EVENT_KEY = ["domain_code", "page_title", "file_date", "file_time"]


def _split(exact: bool) -> Query:
    def query(spark, sf_dir):
        split = sampling.stratified_split(_churn(spark, sf_dir), "churn", ENTITY_KEYS, exact=exact)
        return split.select(*ENTITY_KEYS, "churn", "is_test")

    return query


def standardize(spark, sf_dir):
    columns = ["views_total", "views_mean", "sum_3d"]
    return rounded(modeling.standardize(_churn(spark, sf_dir).select(*ENTITY_KEYS, *columns), columns))


def _scored(dataset: DataFrame) -> DataFrame:
    """A score and a prediction that depend on no model."""
    days = F.col("days_active")
    return dataset.select(
        F.col("churn").alias("label"), (-days.cast("double")).alias("score"), (days <= 2).cast("int").alias("prediction")
    )


def _metric(operator: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(_scored(_churn(spark, sf_dir))))


def _gold(spark, sf_dir) -> DataFrame:
    """The churn set as a written table: models read their input many times."""
    path = scratch_path(spark, "gold")
    tables.write_table(_churn(spark, sf_dir), path, partition_by="days_active")
    return tables.read_table(spark, path, churn.CORE_SCHEMA)


def one_hot_features(spark, sf_dir):
    """Rows per level of each one-hot vector, found by the position of its 1."""
    data = modeling.model_input(_gold(spark, sf_dir))
    columns = ["language", "database_name", "is_mobile", "namespace", "sparsity_level"]
    model = Pipeline(stages=modeling.build_preprocessor(columns, ["days_active"])).fit(data)
    prepared, levels = model.transform(data), dict(zip(columns, model.stages[0].labelsArray))
    vectors = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.array(*map(F.lit, levels[c])).alias("levels"),
                vector_to_array(f"{c}_onehot").alias("vector"),
            )
            for c in columns
        ]
    )
    one = F.array_position("vector", F.lit(1.0)).cast("int")
    return (
        prepared.select(F.inline(vectors))
        .select("column_name", F.element_at("levels", one).alias("level"))
        .groupBy("column_name", "level")
        .agg(F.count("*").alias("n_rows"))
    )


def title_rates(spark, sf_dir):
    """Out-of-fold churn rates of page titles in the train split, and those of the whole split in the held-out rows."""
    train, test = modeling.with_rates(*_train_parts(spark, sf_dir))
    columns = [*ENTITY_KEYS, "churn", "page_title_rate"]
    fitted = train.select(*columns, F.lit(False).alias("is_test"))
    return rounded(fitted.unionByName(test.select(*columns, F.lit(True).alias("is_test"))))


def _grouped(operator: Callable[..., DataFrame]) -> Query:
    """A ranking metric per language, and per sparsity level, which follows the score."""

    def query(spark, sf_dir):
        rows = _churn(spark, sf_dir)
        kinds = F.array(F.struct(F.lit("language").alias("grouped_by"), F.col("language").alias("level")), F.struct(F.lit("sparsity_level").alias("grouped_by"), F.col("sparsity_level").alias("level")))
        scored = rows.select(F.col("churn").alias("label"), (-F.col("views_total").cast("double")).alias("score"), F.inline(kinds))
        return rounded(operator(scored, by=["grouped_by", "level"]))

    return query


def _train_parts(spark, sf_dir):
    split = sampling.stratified_split(_gold(spark, sf_dir), "churn", ENTITY_KEYS)
    return [modeling.model_input(part) for part in sampling.split_parts(split)]


def _fitted(train: DataFrame):
    return modeling.pipeline_for(train, **SMALL_TREES).fit(train)


def gbt_predictions(spark, sf_dir):
    train, test = modeling.with_rates(*_train_parts(spark, sf_dir))
    return modeling.predict(_fitted(train), test, [*ENTITY_KEYS, "churn"])


def model_search(spark, sf_dir):
    train = modeling.with_rates(_train_parts(spark, sf_dir)[0])[0]
    train = sampling.sample_n(train, SEARCH_ROWS, ENTITY_KEYS)
    search = modeling.hyperparameter_search(modeling.pipeline_for(train), train, space=SMALL_SPACE)
    return modeling.search_results(spark, search)


def permutation_importance(spark, sf_dir):
    train, test = modeling.with_rates(*_train_parts(spark, sf_dir))
    return modeling.permutation_importance(_fitted(train), test)


def external_evaluation(spark, sf_dir):
    train = _train_parts(spark, sf_dir)[0]
    later = churn.churn_dataset(
        silver_log(spark, sf_dir), TEST.obs_start, TEST.obs_end, TEST.lbl_start, TEST.lbl_end
    )
    train, later = modeling.with_rates(train, modeling.model_input(later))
    return modeling.evaluate_model(_fitted(train), later, "external")["ranking"]


def queries() -> dict[str, Query]:
    return {
        "bronze_ingest": bronze_ingest,
        "bronze_parse_lines": bronze_parse_lines,
        "bronze_file_filter": bronze_file_filter,
        "bronze_file_timestamp": bronze_file_timestamp,
        "table_roundtrip": table_roundtrip,
        "max_records_per_file": max_records_per_file,
        "gold_partitioned_roundtrip": gold_partitioned_roundtrip,
        "language_split": language_split,
        "link_harvest": link_harvest,
        "link_addresses": link_addresses,
        "pending_files": pending_files,
        "landing_inventory": landing_inventory,
        "ledger_ingest": ledger_ingest,
        "set_row_counts": set_row_counts,
        "quality_checks": quality_checks,
        "quality_report": quality_report,
        "domain_special_filter": domain_special_filter,
        "domain_language": _per_domain("language", checked=False),
        "domain_language_map": _per_domain("language", language_map=True, checked=False),
        "domain_project": _per_domain("database_name"),
        "domain_mobile": _per_domain("is_mobile"),
        "title_namespace": title_namespace,
        "silver_pipeline": silver_log,
        "obs_lbl_windows": obs_lbl_windows,
        "dau": _of_silver(kpis.dau),
        "wau": _of_silver(kpis.wau),
        "mau": _of_silver(kpis.mau),
        "stickiness": stickiness,
        "stickiness_one_pass": _of_silver(kpis.stickiness_from_views),
        "stickiness_bitmaps": stickiness_bitmaps,
        "wau_bitmaps": wau_bitmaps,
        "uniques_from_sketches": uniques_from_sketches,
        "stickiness_pct": stickiness_pct,
        "diversity": _of_silver(kpis.diversity),
        "shannon_entropy": _of_silver(kpis.shannon_entropy),
        "top_n_share": _of_silver(kpis.top_n_share, (2, 5, 10, 100)),
        "page_rank_daily": _of_silver(kpis.page_rank),
        "top_pages_daily": _of_silver(kpis.page_rank, 3),
        "top_pages_bounded": _of_silver(topn.top_pages, 3),
        "top_pages_of_day": _of_silver(topn.top_pages, 25, by=()),
        "dau_share": _of_silver(kpis.dau_share),
        "dau_share_one_vs_rest": dau_share_one_vs_rest,
        "hourly_profile": _of_silver(profiles.hourly_profile),
        "hourly_profile_until": hourly_profile_until,
        "hourly_first_n": _of_silver(profiles.hourly_profile, first_n=218),
        "daily_profile": _of_silver(profiles.daily_profile),
        "daily_vs_hourly": lambda spark, sf_dir: rounded(profiles.daily_vs_hourly(silver_log(spark, sf_dir)), 6),
        "weekend_spine": _of_silver(profiles.weekend_spine_of),
        "daily_entity_views": _of_silver(features.daily_views),
        "rolling_sum_3": _rolling(3),
        "rolling_sum_7": _rolling(7),
        "rolling_sum_7_calendar_days": _rolling(7, "days"),
        "last_day_snapshot": last_day_snapshot,
        "entity_features_core": entity_features_core,
        "entity_features_full": entity_features_full,
        "domain_entropy": _of_silver(features.domain_entropy, ["namespace", "page_title"]),
        "last_domain": _of_silver(features.last_domain, ["namespace", "page_title"]),
        "churn_labels": _of_silver(features.churn_labels, TRAIN),
        "sparsity_levels": _of_churn(features.sparsity_counts),
        "churn_dataset_core": _of_churn(lambda df: df),
        "churn_dataset_full": _of_churn(lambda df: df, kind="full"),
        "train_test_sets": train_test_sets,
        "train_test_sets_of_states": train_test_sets_of_states,
        "churn_dataset_full_of_states": churn_dataset_full_of_states,
        "churn_rate_by_sparsity": _of_churn(explore.churn_rate_by_sparsity),
        "feature_box_stats": _of_churn(explore.feature_box_stats, kind="full"),
        "dedup_latest": dedup_latest,
        "late_upsert": late_upsert,
        "late_upsert_days": late_upsert_days,
        "cluster_rewrite": _clustered("count_views", "page_title"),
        "cluster_rewrite_range": _clustered("page_title", "count_views"),
        "sample_fraction": _of_silver(sampling.sample_fraction, 0.05, EVENT_KEY),
        "sample_n": _of_churn(sampling.sample_n, 500, ENTITY_KEYS),
        "stratified_split": _split(exact=False),
        "stratified_split_exact": _split(exact=True),
        "standardize": standardize,
        "one_hot_features": one_hot_features,
        "title_rates": title_rates,
        "roc_auc_grouped": _grouped(metrics.roc_auc),
        "average_precision_grouped": _grouped(metrics.average_precision),
        "gbt_predictions": gbt_predictions,
        "model_search": model_search,
        "roc_auc": _metric(metrics.roc_auc),
        "average_precision": _metric(metrics.average_precision),
        "classification_report": _metric(metrics.classification_report),
        "permutation_importance": permutation_importance,
        "external_evaluation": external_evaluation,
    }
