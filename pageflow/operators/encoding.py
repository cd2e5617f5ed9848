"""Target statistics: a column with very many levels as the mean label of its level, without leaks.

A row's own fold takes no part in its rate, so no label is learnt from itself. Rates of rare levels are
shrunk towards the mean of all rows outside the fold, as if ``strength`` rows with that mean were added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions import expressions as E
from pageflow.functions.fixed_values import SEED
from pageflow.functions.hashing import row_hash
from pageflow.functions.selection import class_map

FOLDS = 5
STRENGTH = 20.0


def fold_of(key_cols: Sequence[str], folds: int = FOLDS, seed: int = SEED) -> Column:
    """A fold from the row hash, the same however the rows are partitioned."""
    return (F.conv(F.substring(row_hash(key_cols, seed), 1, 8), 16, 10).cast("long") % folds).cast("int")


def level_counts(train: DataFrame, column: str, label: str, fold: Column) -> DataFrame:
    """Per level: rows ``n`` and labels ``s``, in all and in each fold. A level has one row, however frequent it is."""
    per_fold = train.groupBy(F.col(column).alias("_level"), fold.alias("_fold")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("s")
    )
    return per_fold.groupBy("_level").agg(
        F.map_from_entries(F.collect_list(F.struct("_fold", F.struct("n", "s")))).alias("_folds"), F.sum("n").alias("_n"), F.sum("s").alias("_s")
    )


def cross_fitted_rates(
    train: DataFrame,
    column: str,
    label: str,
    key_cols: Sequence[str],
    others: Sequence[DataFrame] = (),
    folds: int = FOLDS,
    strength: float = STRENGTH,
    seed: int = SEED,
    name: str | None = None,
) -> list[DataFrame]:
    """``train`` with out-of-fold rates of the column, and the other sets with the rates of all of ``train``.

    A level that ``train`` does not have gets the mean of all rows; NULL is a level. Rows are joined with a table of
    one row per level; no row is moved for the counts but partial sums.
    """
    name = name or f"{column}_rate"
    fold = fold_of(key_cols, folds, seed)
    levels = level_counts(train, column, label, fold)
    sums = train.groupBy(fold.alias("_fold")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("s"))
    by_fold = class_map(sums, ["_fold"], F.struct("n", "s"))
    whole = sums.agg(F.struct(F.sum("n").alias("n"), F.sum("s").alias("s")).alias("_all")).scalar()

    def joined(rows: DataFrame) -> DataFrame:
        return rows.join(levels, rows[column].eqNullSafe(levels["_level"]), "left")

    def rate(n: Column, s: Column, mean: Column) -> Column:
        return F.coalesce((s + strength * mean) / (n + strength), mean)

    n, s, own = levels["_n"], levels["_s"], F.element_at(levels["_folds"], fold)
    rest = F.element_at(by_fold, F.concat(F.lit("+"), fold.cast("string"), F.lit("\x1f")))
    outside = E.ratio(whole["s"] - rest["s"], whole["n"] - rest["n"])
    out = [joined(train).select(*[train[c] for c in train.columns], rate(n - own["n"], s - own["s"], outside).alias(name))]
    mean = E.ratio(whole["s"], whole["n"])
    for rows in others:
        out.append(joined(rows).select(*[rows[c] for c in rows.columns], rate(n, s, mean).alias(name)))
    return out
