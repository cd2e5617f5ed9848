"""Per-entity features and labels: the single steps, each usable on its own.

``pageflow.plans.churn`` puts them together in one plan.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.fixed_values import ENTITY_KEYS

DAY = "file_date"


def to_day(value: str | datetime.date) -> datetime.date:
    return value if isinstance(value, datetime.date) else datetime.date.fromisoformat(value)


@dataclass(frozen=True)
class Windows:
    """Observation and label window, all four days inclusive."""

    obs_start: datetime.date
    obs_end: datetime.date
    lbl_start: datetime.date
    lbl_end: datetime.date

    @classmethod
    def of(cls, obs_start, obs_end, lbl_start, lbl_end) -> Windows:
        windows = cls(*map(to_day, (obs_start, obs_end, lbl_start, lbl_end)))
        if not windows.obs_start <= windows.obs_end < windows.lbl_start <= windows.lbl_end:
            raise ValueError(f"the label window must follow the observation window: {windows}")
        return windows

    def observed(self, day: Column) -> Column:
        return day.between(F.lit(self.obs_start), F.lit(self.obs_end))

    def labelled(self, day: Column) -> Column:
        return day.between(F.lit(self.lbl_start), F.lit(self.lbl_end))


def all_present(columns: Sequence[str]) -> Column:
    """No column is NULL. Plain tests, so that Spark drops those on columns that cannot be."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def observation_rows(df: DataFrame, windows: Windows) -> DataFrame:
    """Rows of the observation window; typed literals, so partitions are pruned."""
    return df.where(windows.observed(F.col(DAY)))


def label_rows(df: DataFrame, windows: Windows) -> DataFrame:
    return df.where(windows.labelled(F.col(DAY)))


def daily_views(df: DataFrame, key_cols: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Views per entity and day, with the day of the week (1 = Sunday)."""
    return (
        df.groupBy(DAY, *key_cols)
        .agg(F.sum("count_views").alias("views_day"))
        .select(DAY, F.dayofweek(DAY).alias("dow"), *key_cols, "views_day")
    )


def rolling_sum(
    daily: DataFrame, n: int, key_cols: Sequence[str] = ENTITY_KEYS, frame: str = "rows", name: str | None = None
) -> DataFrame:
    """Sum over the last n active days of an entity, or with ``frame="days"`` over n calendar days.

    An entity has at most one row per day, so its window stays small however many views it has.
    """
    spec = Window.partitionBy(*key_cols)
    total = F.sum("views_day").over(last_days(spec, n, F.col(DAY), frame))
    return daily.withColumn(name or f"sum_{n}d", total)


def last_days(spec, n: int, day: Column, frame: str):
    """Window frame of the last n active days (``"rows"``) or calendar days (``"days"``)."""
    if frame == "rows":
        return spec.orderBy(day).rowsBetween(1 - n, 0)
    if frame == "days":
        return spec.orderBy(F.unix_date(day)).rangeBetween(1 - n, 0)
    raise ValueError(f"frame must be 'rows' or 'days', not {frame!r}")


def last_day_snapshot(
    daily: DataFrame, day: str | datetime.date, key_cols: Sequence[str] = ENTITY_KEYS, sums: Sequence[int] = (3,)
) -> DataFrame:
    """Views and rolling sums of the entities that were active on exactly that day."""
    for n in sums:
        daily = rolling_sum(daily, n, key_cols)
    return daily.where(F.col(DAY) == F.lit(to_day(day))).select(
        *key_cols, F.col("views_day").alias("views_last_day"), *[f"sum_{n}d" for n in sums]
    )


def core_aggregates(day: Column, views: Column) -> dict[str, Column]:
    """Aggregates over one row per active day; all of them combine before the shuffle.

    Days are distinct within an entity, so active days are a plain count, and the weekdays seen are
    the bits of one number: no distinct aggregation is needed. ``views_std_dow`` is by definition
    the same deviation as ``views_std``.
    """
    weekday_bit = F.call_function("shiftleft", F.lit(1), F.dayofweek(day))
    return {
        "days_active": F.count(day),
        "views_total": F.sum(views),
        "views_mean": F.avg(views),
        "views_std": F.stddev_pop(views),
        "unique_weekdays": F.bit_count(F.bit_or(weekday_bit)).cast("long"),
        "views_std_dow": F.stddev_pop(views),
    }


def full_aggregates(day: Column, views: Column, origin: Column) -> dict[str, Column]:
    """The wider set: extremes, discrete median, trend against the days since ``origin``."""
    return core_aggregates(day, views) | {
        "views_max": F.max(views),
        "views_median": F.percentile_approx(views, 0.5),
        "trend_slope": F.regr_slope(views, F.datediff(day, origin)),
        "first_dow": F.dayofweek(F.min(day)),
    }


def entity_features(
    daily: DataFrame,
    key_cols: Sequence[str] = ENTITY_KEYS,
    features: str = "core",
    obs_start: str | datetime.date | None = None,
) -> DataFrame:
    """Activity features of each entity, ``"core"`` or ``"full"`` (which needs ``obs_start``)."""
    day, views = F.col(DAY), F.col("views_day")
    if features == "core":
        chosen = core_aggregates(day, views)
    elif features == "full" and obs_start is not None:
        chosen = full_aggregates(day, views, F.lit(to_day(obs_start)))
    else:
        raise ValueError("features must be 'core', or 'full' with obs_start")
    return daily.groupBy(*key_cols).agg(*[c.alias(name) for name, c in chosen.items()])


def domain_entropy(
    df: DataFrame, key_cols: Sequence[str] = ENTITY_KEYS, domain: str = "domain_code"
) -> DataFrame:
    """How evenly an entity's views spread over its domain codes, plain and scaled to 0..1."""
    v = F.col("_v")
    per_domain = df.where(F.col(domain).isNotNull()).groupBy(*key_cols, domain).agg(F.sum("count_views").alias("_v"))
    sums = per_domain.groupBy(*key_cols).agg(
        F.count("*").alias("n_domains"), F.sum(v).alias("_total"), F.sum(E.v_ln_v(v)).alias("_vlnv")
    )
    entropy = E.entropy_of_sums(F.col("_total"), F.col("_vlnv"))
    return sums.select(
        *key_cols, "n_domains", entropy.alias("views_entropy"), normalized(entropy, F.col("n_domains")).alias("views_entropy_norm")
    )


def normalized(entropy: Column, n: Column) -> Column:
    return F.when(n > 1, entropy / F.ln(n.cast("double"))).otherwise(F.lit(0.0))


def time_number(time: Column) -> Column:
    """``HH:mm:ss`` as a number in the same order; NULL when it is not a time."""
    return F.translate(time, ":", "").try_cast("int")


def last_domain(df: DataFrame, key_cols: Sequence[str] = ENTITY_KEYS, domain: str = "domain_code") -> DataFrame:
    """Domain code of an entity's last hour; within that hour the greatest code.

    Page views are first reduced to one number per entity and code, which needs no sorting.
    """
    hour = F.unix_date(DAY).cast("long") * 1_000_000 + F.coalesce(time_number(F.col("file_time")), F.lit(-1))
    per_code = df.groupBy(*key_cols, domain).agg(F.max(hour).alias("_hour"))
    newest = F.max(F.struct("_hour", domain)).alias("_newest")
    return per_code.groupBy(*key_cols).agg(newest).select(*key_cols, F.col(f"_newest.{domain}").alias(domain))


def churn_labels(df: DataFrame, windows: Windows, key_cols: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """1 for entities observed but not seen in the label window, else 0.

    Both windows are read in one pass and reduced to two flags per entity.
    """
    day = F.col(DAY)
    in_obs, in_lbl = windows.observed(day), windows.labelled(day)
    return (
        df.where(in_obs | in_lbl)
        .groupBy(*key_cols)
        .agg(F.max(in_obs & all_present(key_cols)).alias("_observed"), F.max(in_lbl).alias("_alive"))
        .where("_observed")
        .select(*key_cols, F.when(F.col("_alive"), 0).otherwise(1).alias("churn"))
    )


def sparsity_counts(dataset: DataFrame) -> DataFrame:
    """Entities per sparsity level."""
    return dataset.groupBy("sparsity_level").agg(F.count("*").alias("n_entities"))
