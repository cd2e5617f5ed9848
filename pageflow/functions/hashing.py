"""Seeded, engine-independent row hashes for sampling, splitting and shuffling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_hash(key_cols: Sequence[str], seed: int | str | Column) -> Column:
    """Hex md5 over the key columns and a seed; NULL counts as an empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    salt = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws("|", *texts, salt))


def hash_below(hashed: Column, fraction: float) -> Column:
    """True for the given fraction of evenly spread hashes (by their first 32 bits)."""
    bound = round(fraction * 2**32)
    if bound >= 2**32:
        return F.lit(True)
    return F.substring(hashed, 1, 8) < F.lit(f"{bound:08x}")


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``hash_rank`` (1..n in hash order, per group) and ``hash_rows`` (n).

    Hashes are evenly spread, so their first three digits cut every group, however large, into
    4,096 equal ranges: counts per range give offsets, and rows are numbered inside a range only.
    """
    hashed = df.withColumn("_hash", row_hash(key_cols, seed)).withColumn("_range", F.substring("_hash", 1, 3))
    counts = hashed.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_range").alias("_by_range"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("hash_rows"),
    )
    matches = F.col("_range") == F.col("_by_range")
    for c in by:
        matches = matches & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = Window.partitionBy(*by, "_range").orderBy("_hash", *key_cols)
    return (
        hashed.join(offsets, matches)
        .withColumn("hash_rank", F.col("_before") + F.row_number().over(inside))
        .drop("_hash", "_range", "_by_range", "_before", *[f"_by_{c}" for c in by])
    )
