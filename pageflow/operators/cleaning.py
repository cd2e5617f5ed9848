"""From raw log rows to typed page views: quality rules, domain parts, namespaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.fixed_values import (
    DEFAULT_NAMESPACE,
    MAX_VIEWS,
    MIN_VIEWS,
    NAMESPACES,
    PLACEHOLDER_TITLE,
    SPECIAL_DOMAINS,
)


def quality_rules() -> dict[str, Column]:
    """Each rule is true for a good row and never NULL."""
    title = F.col("page_title")
    return {
        "views_in_range": F.coalesce(F.col("count_views").between(MIN_VIEWS, MAX_VIEWS), F.lit(False)),
        "domain_present": F.col("domain_code").isNotNull(),
        "title_present": title.isNotNull(),
        "title_not_placeholder": F.coalesce(title != PLACEHOLDER_TITLE, F.lit(True)),
    }


def quality_checks(df: DataFrame) -> DataFrame:
    """Keeps rows that meet every rule (written so that the scan can use the predicates)."""
    return df.where(
        F.col("count_views").between(MIN_VIEWS, MAX_VIEWS)
        & F.col("domain_code").isNotNull()
        & (F.col("page_title") != PLACEHOLDER_TITLE)
    )


def quality_report(df: DataFrame) -> DataFrame:
    """Rows in all, rows failing each rule, and rows kept, in one pass."""
    rules = quality_rules()
    kept = F.lit(True)
    for rule in rules.values():
        kept = kept & rule
    return df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(~rule).alias(f"failed_{name}") for name, rule in rules.items()],
        F.count_if(kept).alias("n_kept"),
    )


def drop_special_domains(df: DataFrame) -> DataFrame:
    return df.where(~E.first_domain_part(F.col("domain_code")).isin(SPECIAL_DOMAINS))


def derive_domain(df: DataFrame, language_map: bool = False) -> DataFrame:
    """Adds language, project and mobile flag; drops special domains and unknown languages.

    Languages are looked up by a broadcast join with the fixed 184-row table: one hash probe per
    row. ``language_map`` indexes a constant map instead, with the same results, but Spark searches
    such a map from its start for every row.
    """
    code, parts = E.first_domain_part(F.col("domain_code")), F.col("_parts")
    rows = drop_special_domains(df)
    if language_map:
        rows = rows.withColumn("language", E.language_name(code)).where(F.col("language").isNotNull())
    else:
        names = F.broadcast(E.language_dimension(df.sparkSession))
        rows = rows.join(names, code == F.col("language_code")).drop("language_code")
    return rows.withColumn("_parts", E.domain_parts(F.col("domain_code"))).select(
        *df.columns,
        "language",
        E.project_name(parts).alias("database_name"),
        E.mobile_flag(parts).alias("is_mobile"),
    )


def split_title(df: DataFrame, normalize_underscores: bool = False) -> DataFrame:
    """Splits ``Namespace:Title`` at the first colon and keeps the known namespaces.

    By default a prefix must match to the letter, so ``User_talk:X`` and titles that merely contain
    a colon are dropped; ``normalize_underscores`` reads ``_`` in a prefix as a blank.
    """
    title = F.col("page_title")
    has_prefix, prefix = title.contains(":"), F.substring_index(title, ":", 1)
    if normalize_underscores:
        prefix = F.translate(prefix, "_", " ")
    rest = F.substr(title, F.instr(title, ":") + 1)
    return df.where(~has_prefix | prefix.isin(NAMESPACES)).withColumns(
        {
            "namespace": F.when(has_prefix, prefix).otherwise(DEFAULT_NAMESPACE),
            "page_title": F.when(has_prefix, rest).otherwise(title),
        }
    )


def silver(df: DataFrame, language_map: bool = False, normalize_underscores: bool = False) -> DataFrame:
    """The whole cleaning step; narrow transformations only, so it never shuffles."""
    return (
        df.transform(quality_checks)
        .transform(derive_domain, language_map)
        .drop("total_response_size")
        .transform(split_title, normalize_underscores)
    )
