"""Exploration of a churn data set: churn rates and box statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import BOX_FEATURES, DENSEST_LEVEL, SPARSITY_LEVELS
from pageflow.functions.selection import QUARTILES, bracketed_values, quartiles_over


def churn_rate_by_sparsity(dataset: DataFrame) -> DataFrame:
    """Mean of the churn flag per sparsity level, from very sparse to frequent."""
    levels = F.array(*[F.lit(name) for name in [*SPARSITY_LEVELS, DENSEST_LEVEL]])
    return (
        dataset.groupBy("sparsity_level")
        .agg(F.avg("churn").alias("churn_rate"), F.count("*").alias("n_entities"))
        .orderBy(F.array_position(levels, F.col("sparsity_level")))
    )


def feature_box_stats(
    dataset: DataFrame, features: Sequence[str] = BOX_FEATURES, by: str = "churn"
) -> DataFrame:
    """Quartiles and whiskers (farthest values within 1.5 IQR) of each feature per class.

    Exact, by bracketing: a sketch of each class bounds the places to look at, a second pass counts the values
    between the brackets and keeps those inside. Neither joins or orders the values, and only the
    kept ones are shuffled. NULL and NaN are left out; a NULL class is a class.
    """
    values = [F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f) for f in features]
    rows = bracketed_values(dataset.select(by, *values), features, [by])
    boxes = quartiles_over(rows, ["feature", by])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return boxes.groupBy("feature", by, "n_values", *QUARTILES).agg(
        F.min(F.when(F.col("least") >= F.col("q1") - reach, F.col("least"))).alias("whisker_low"),
        F.max(F.when(F.col("most") <= F.col("q3") + reach, F.col("most"))).alias("whisker_high"),
    )
