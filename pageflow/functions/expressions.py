"""Column expressions: dates, ratios, and the parts of a domain code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from pageflow.functions.fixed_values import (
    DEFAULT_PROJECT,
    DENSEST_LEVEL,
    LANGUAGES,
    MOBILE_SUFFIX,
    PROJECT_SUFFIXES,
    SPARSITY_LEVELS,
)


def as_date(df: DataFrame, name: str) -> Column:
    """The column as DATE; strings may be written ``yyyyMMdd`` or ``yyyy-MM-dd``."""
    column, dtype = F.col(name), df.schema[name].dataType
    if isinstance(dtype, DateType):
        return column
    if isinstance(dtype, StringType):
        formats = [F.lit("yyyyMMdd"), F.lit("yyyy-MM-dd")]
        return F.coalesce(*[F.try_to_timestamp(column, f) for f in formats]).cast("date")
    return column.cast("date")


def iso_week(day: Column) -> Column:
    """ISO year and week, for instance ``2025-01`` for 2024-12-30."""
    return F.format_string("%04d-%02d", F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE, NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def entropy_of_sums(total: Column, sum_v_ln_v: Column) -> Column:
    """Natural-log entropy of a distribution from T = sum(v) and S = sum(v ln v), as ln T - S / T.

    One pass over the values, so no join or window is needed to get shares first.
    """
    entropy = F.ln(total.cast("double")) - F.coalesce(sum_v_ln_v, F.lit(0.0)) / total
    return F.when(total > 0, F.greatest(entropy, F.lit(0.0))).otherwise(F.lit(0.0))


def v_ln_v(views: Column) -> Column:
    """Entropy summand; NULL (skipped by SUM) where there are no views."""
    return F.when(views > 0, views * F.ln(views.cast("double")))


def domain_parts(code: Column) -> Column:
    return F.split(code, r"\.")


def first_domain_part(code: Column) -> Column:
    return F.substring_index(code, ".", 1)


def language_name(code: Column) -> Column:
    """Language of a two-letter code from a constant map; NULL when unknown."""
    pairs = [F.lit(text) for item in LANGUAGES.items() for text in item]
    return F.create_map(*pairs)[code]


def language_dimension(spark: SparkSession) -> DataFrame:
    """The fixed code/name table (184 rows) for use in a broadcast join."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in LANGUAGES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS languages(language_code, language)")


def project_name(parts: Column) -> Column:
    """Project named by the first suffix, in order of priority, that the code carries.

    An intersection keeps the order of its first array, so its first element is the one that wins.
    """
    suffixes = F.array(*[F.lit(s) for s in PROJECT_SUFFIXES])
    names = F.create_map(*[F.lit(text) for item in PROJECT_SUFFIXES.items() for text in item])
    return F.coalesce(names[F.get(F.array_intersect(suffixes, parts), 0)], F.lit(DEFAULT_PROJECT))


def mobile_flag(parts: Column) -> Column:
    return F.coalesce(F.array_contains(parts, MOBILE_SUFFIX), F.lit(False))


def sparsity_level(days_active: Column) -> Column:
    levels = list(SPARSITY_LEVELS.items())
    first, bound = levels[0]
    return reduce(
        lambda arm, level: arm.when(days_active <= level[1], level[0]),
        levels[1:],
        F.when(days_active <= bound, first),
    ).otherwise(DENSEST_LEVEL)
