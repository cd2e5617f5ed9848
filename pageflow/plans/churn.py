"""Churn data sets as one plan: two shuffles, no join, any number of window pairs.

1. Views are summed per entity and day (per domain code too for the full set). Partial sums are
   combined before the shuffle, so a page with a third of all views sends a few rows per task.
2. What is left, at most one row per entity and day (and code), is shuffled by entity. Rolling
   sums, features, the last-day snapshot and the label all come from that one arrangement, in the
   order of days. Days of the label window come last, and the aggregates see them as NULL.

Aggregates before a shuffle keep to fixed-width buffers (a time of day is a number, not a text), or
Spark would sort the page views instead of hashing them.
"""

from __future__ import annotations

import datetime
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.fixed_values import ENTITY_KEYS
from pageflow.operators.features import (
    DAY,
    Windows,
    all_present,
    core_aggregates,
    full_aggregates,
    last_days,
    normalized,
    time_number,
)

SET_NAME = "set_name"
CORE_COLUMNS = [
    "days_active",
    "views_total",
    "views_mean",
    "views_std",
    "unique_weekdays",
    "views_std_dow",
    "views_last_day",
    "sum_3d",
    "sparsity_level",
    "churn",
]
FULL_COLUMNS = [
    *CORE_COLUMNS[:-2],
    "sum_7d",
    "views_max",
    "views_median",
    "trend_slope",
    "first_dow",
    "n_domains",
    "views_entropy",
    "views_entropy_norm",
    "is_zero_history",
    "is_sparse",
    "sparsity_level",
    "churn",
    "domain_code",
]
CORE_SCHEMA = (
    "language string, database_name string, is_mobile boolean, namespace string, page_title string, "
    "days_active bigint, views_total bigint, views_mean double, views_std double, unique_weekdays bigint, "
    "views_std_dow double, views_last_day bigint, sum_3d bigint, sparsity_level string, churn int"
)


def churn_dataset(
    df: DataFrame,
    obs_start: str | datetime.date,
    obs_end: str | datetime.date,
    lbl_start: str | datetime.date,
    lbl_end: str | datetime.date,
    key_cols: Sequence[str] = ENTITY_KEYS,
    features: str = "core",
    frame: str = "rows",
) -> DataFrame:
    """One row per entity seen in the observation window: its features and whether it churned."""
    windows = {"": Windows.of(obs_start, obs_end, lbl_start, lbl_end)}
    return churn_datasets(df, windows, key_cols, features, frame).drop(SET_NAME)


def train_test_sets(
    df: DataFrame,
    train: Windows,
    test: Windows,
    key_cols: Sequence[str] = ENTITY_KEYS,
    features: str = "core",
    frame: str = "rows",
) -> DataFrame:
    """Both sets from one pass, told apart by ``set_name``."""
    if test.obs_start <= train.lbl_end and train.lbl_start <= test.obs_end:
        warnings.warn("the test observation window contains days the train labels come from", stacklevel=2)
    return churn_datasets(df, {"train": train, "test": test}, key_cols, features, frame)


def churn_datasets(
    df: DataFrame,
    windows: Mapping[str, Windows],
    key_cols: Sequence[str] = ENTITY_KEYS,
    features: str = "core",
    frame: str = "rows",
) -> DataFrame:
    full = _is_full(features)
    summed = [F.sum("count_views").alias("_v")]
    if full:
        summed.append(F.max(time_number(F.col("file_time"))).alias("_time"))
    daily = _needed(df, windows).groupBy(*key_cols, *(["domain_code"] if full else []), DAY).agg(*summed)
    return _sets(daily, windows, key_cols, full, frame)


def sets_of_days(
    states: DataFrame,
    windows: Mapping[str, Windows],
    key_cols: Sequence[str] = ENTITY_KEYS,
    features: str = "core",
    frame: str = "rows",
    arranged: bool = False,
) -> DataFrame:
    """The sets from rows per entity, domain code and day (views ``_v``, last time ``_time``).

    ``arranged`` says that the rows lie by entity already, as those of a bucketed table do.
    """
    full = _is_full(features)
    daily = _needed(states, windows)
    if not full:
        daily = daily.groupBy(*key_cols, DAY).agg(F.sum("_v").alias("_v"))
    return _sets(daily, windows, key_cols, full, frame, arranged)


def _is_full(features: str) -> bool:
    if features not in ("core", "full"):
        raise ValueError(f"features must be 'core' or 'full', not {features!r}")
    return features == "full"


def _needed(df: DataFrame, windows: Mapping[str, Windows]) -> DataFrame:
    """The rows of days in any window."""
    day = F.col(DAY)
    needed = F.lit(False)
    for w in windows.values():
        needed = needed | w.observed(day) | w.labelled(day)
    # The envelope repeats what "needed" implies, in the plain form that prunes partitions.
    first, last = min(w.obs_start for w in windows.values()), max(w.lbl_end for w in windows.values())
    return df.where(day.between(F.lit(first), F.lit(last)) & needed)


def _sets(
    daily: DataFrame, windows: Mapping[str, Windows], key_cols: Sequence[str], full: bool, frame: str, arranged: bool = False
) -> DataFrame:
    keys = list(key_cols)
    tagged = _tag_sets(daily, windows)
    entity = [SET_NAME, *keys]
    if full:
        tagged = _fold_domains(tagged, entity, arranged)
    by_entity = Window.partitionBy(*entity)
    sums = [3, 7] if full else [3]
    rolled = tagged.withColumns(
        {f"_sum_{n}d": F.sum("_v").over(last_days(by_entity, n, F.col(DAY), frame)) for n in sums}
    )
    return _summarize(rolled, entity, sums, full).select(
        SET_NAME, *keys, *(FULL_COLUMNS if full else CORE_COLUMNS)
    )


def _is_observed() -> Column:
    return F.col(DAY) <= F.col("_end")


def _tag_sets(daily: DataFrame, windows: Mapping[str, Windows]) -> DataFrame:
    """One row per set a day belongs to, with the bounds of that set's observation window."""
    day = F.col(DAY)
    tags = [
        F.when(
            w.observed(day) | w.labelled(day),
            F.struct(F.lit(name).alias(SET_NAME), F.lit(w.obs_start).alias("_origin"), F.lit(w.obs_end).alias("_end")),
        )
        for name, w in windows.items()
    ]
    if len(tags) == 1:
        tagged = daily.withColumn("_tag", tags[0])
    else:
        tagged = daily.withColumn("_tag", F.explode(F.array_compact(F.array(*tags))))
    return tagged.select(*daily.columns, "_tag.*")


def _fold_domains(tagged: DataFrame, entity: Sequence[str], arranged: bool = False) -> DataFrame:
    """From rows per domain code and day to rows per day, keeping what the entropy needs.

    The explicit repartition by entity serves all later windows and aggregations of the plan; rows that are
    ``arranged`` by entity need none. Each code's total is added on one of its rows only, so that the
    sums over days are right.
    """
    in_code = Window.partitionBy(*entity, "domain_code").orderBy(DAY)
    whole_code = in_code.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    views = F.when(_is_observed(), F.col("_v"))
    placed = tagged if arranged else tagged.repartition(*[F.col(c) for c in entity])
    return (
        placed.withColumns(
            {
                "_code_total": F.sum(views).over(whole_code),
                "_is_first": _is_observed() & (F.row_number().over(in_code) == 1),
            }
        )
        .groupBy(*entity, DAY, "_origin", "_end")
        .agg(
            F.sum("_v").alias("_v"),
            F.max(F.struct("_time", "domain_code")).alias("_latest"),
            F.count_if("_is_first").alias("_codes"),
            F.sum(F.when(F.col("_is_first"), E.v_ln_v(F.col("_code_total")))).alias("_vlnv"),
        )
    )


def _summarize(daily: DataFrame, entity: Sequence[str], sums: Sequence[int], full: bool) -> DataFrame:
    day, views = F.when(_is_observed(), F.col(DAY)), F.when(_is_observed(), F.col("_v"))
    at_end = F.col(DAY) == F.col("_end")
    chosen = full_aggregates(day, views, F.col("_origin")) if full else core_aggregates(day, views)
    chosen["views_last_day"] = F.coalesce(F.max(F.when(at_end, views)), F.lit(0))
    for n in sums:
        chosen[f"sum_{n}d"] = F.coalesce(F.max(F.when(at_end, F.col(f"_sum_{n}d"))), F.lit(0))
    # Tested on the summed rows: a plain filter on the keys would be pushed down to the page views and
    # evaluate there, for every row, all the expressions the keys are made of.
    chosen["_has_keys"] = F.bool_and(all_present(entity[1:]))
    chosen["churn"] = F.when(F.max(day.isNull()), 0).otherwise(1)
    if full:
        chosen["n_domains"] = F.sum("_codes")
        chosen["_vlnv"] = F.sum("_vlnv")
        chosen["domain_code"] = F.max_by("_latest.domain_code", day)

    result = daily.groupBy(*entity).agg(*[c.alias(name) for name, c in chosen.items()])
    result = result.where("days_active > 0 and _has_keys")
    result = result.withColumn("sparsity_level", E.sparsity_level(F.col("days_active")))
    if full:
        entropy = E.entropy_of_sums(F.col("views_total"), F.col("_vlnv"))
        result = result.withColumns(
            {
                "views_entropy": entropy,
                "views_entropy_norm": normalized(entropy, F.col("n_domains")),
                "is_zero_history": F.col("views_total") == 0,
                "is_sparse": F.col("days_active") <= 2,
            }
        )
    return result
