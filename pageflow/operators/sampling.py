"""Seeded samples and splits that do not depend on how the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import SEED, TEST_SHARE
from pageflow.functions.hashing import hash_below, row_hash
from pageflow.functions.selection import first_by_hash


def sample_fraction(df: DataFrame, fraction: float, key_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """Rows whose hash falls into the fraction; a filter, so nothing is shuffled."""
    return df.where(hash_below(row_hash(key_cols, seed), fraction))


def sample_n(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """The n rows that come first in hash order (all rows, if there are fewer), in no order.

    The n-th hash is found by counting leading digits, the sample is then a filter: nothing is sorted or merged into one
    task, however large n is. Runs small jobs when called; the rows should be the same each time they are read.
    """
    if n <= 0:
        return df.limit(0)
    marked = first_by_hash(df.withColumn("_hash", row_hash(key_cols, seed)), [], F.lit(n))
    return marked.where("is_first").drop("_hash", "is_first")


def stratified_split(
    df: DataFrame,
    label: str,
    key_cols: Sequence[str],
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    exact: bool = False,
) -> DataFrame:
    """Adds ``is_test``, true for the given share of every class.

    By hash alone the share holds up to sampling error and costs nothing. ``exact`` takes the first ceil(share * n) rows
    of each class in hash order, up to a hash found by counting; small jobs run for it when called.
    """
    if not exact:
        return df.withColumn("is_test", hash_below(row_hash(key_cols, seed), test_share))
    hashed = df.withColumn("_hash", row_hash(key_cols, seed))
    return first_by_hash(hashed, [label], F.ceil(F.col("n") * F.lit(test_share)), "is_test").drop("_hash")


def split_parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of a split."""
    return df.where(~F.col("is_test")).drop("is_test"), df.where("is_test").drop("is_test")
