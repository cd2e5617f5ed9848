"""Exact order statistics by selection instead of sorting: brackets around quantiles, radix selection of hashes.

Both look at all rows a few times with small aggregates and never order them. What a class needs to
know (bounds, thresholds) goes to the tasks as one map with an entry per class, of which there may be
``MOST_CLASSES`` at most; more raise an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_CLASSES = 10_000
# Rank error of the sketch that the brackets come from, as a share of the rows is 1 / ACCURACY.
ACCURACY = 10_000
MARGIN = 2.5 / ACCURACY
# Classes with fewer values are kept whole; above, the margin is several ranks wide.
WHOLE = 2 * ACCURACY
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
DIGITS = 4
HEX_DIGITS = 32


def class_key(columns: Sequence[str]) -> Column:
    """A text that names the values of the columns, NULL too."""
    return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit("-")) for c in columns], F.lit(""))


def class_map(table: DataFrame, by: Sequence[str], value: Column) -> Column:
    """The value of each class as one map, for use in rows of other tables."""
    entries = table.limit(MOST_CLASSES + 1).select(F.struct(class_key(by).alias("k"), value.alias("v")).alias("e"))
    whole = entries.agg(F.collect_list("e").alias("e")).select(
        F.when(F.size("e") <= MOST_CLASSES, F.map_from_entries("e")).otherwise(F.raise_error(F.lit(f"more than {MOST_CLASSES} classes")))
    )
    return whole.scalar()


# ---- quantiles


def brackets(values: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per class and feature, ranges that hold its quartiles and the ends of 1.5 interquartile ranges around them.

    One pass with a mergeable sketch; a row per class, with a struct per feature.
    """
    edges = [p + side * MARGIN for p in QUARTILES.values() for side in (-1, 1)]
    found = values.groupBy(*by).agg(
        *[F.percentile_approx(f, edges, ACCURACY).alias(f"_{f}") for f in features], *[F.count(f).alias(f"_n_{f}") for f in features]
    )
    return found.select(*by, *[_ranges(F.col(f"_{f}"), F.col(f"_n_{f}")).alias(f) for f in features])


def _ranges(edge: Column, n: Column) -> Column:
    q1, q3 = (edge[0], edge[1]), (edge[4], edge[5])
    slack = F.lit(1e-12) * (F.abs(q1[0]) + F.abs(q3[1]))  # for the rounding of the ends
    ranges = {
        "low": (2.5 * q1[0] - 1.5 * q3[1] - slack, 2.5 * q1[1] - 1.5 * q3[0] + slack),
        "q1": q1,
        "median": (edge[2], edge[3]),
        "q3": q3,
        "high": (2.5 * q3[0] - 1.5 * q1[1] - slack, 2.5 * q3[1] - 1.5 * q1[0] + slack),
    }
    all_of = (F.lit(float("-inf")), F.lit(float("inf")))
    parts = [
        F.when(n < WHOLE, end).otherwise(bound).alias(f"{name}_{side}")
        for name, bounds in ranges.items()
        for side, bound, end in zip(("from", "to"), bounds, all_of)
    ]
    return F.struct(*parts)


RANGES = ("low", "q1", "median", "q3", "high")


def bracketed_values(values: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """All values reduced to ``feature``, class, ``least``, ``most``, ``n`` and ``kept``.

    Values inside a bracket keep their own row with the number of their occurrences; those in a gap between brackets
    share one row. Rows of a class and feature do not overlap, so their counts give exact ranks.
    """
    bounds = class_map(brackets(values, features, by), by, F.struct(*features))
    own = values.withColumn("_bounds", F.element_at(bounds, class_key(by)))
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value"), F.col("_bounds")[f].alias("b")) for f in features])
    rows = own.select(*by, F.inline(each)).where(F.col("value").isNotNull())
    value, b = F.col("value"), F.col("b")
    kept, gap = F.lit(False), F.lit(0)
    for name in RANGES:
        kept = kept | value.between(b[f"{name}_from"], b[f"{name}_to"])
        gap = gap + (b[f"{name}_to"] < value).cast("int")
    placed = rows.select(*by, "feature", "value", F.when(kept, value).alias("own"), F.when(kept, -1).otherwise(gap).alias("gap"))
    return (
        placed.groupBy("feature", *by, "own", "gap")
        .agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
        .select("feature", *by, "n", "least", "most", F.col("own").isNotNull().alias("kept"))
    )


def quartiles_over(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Adds ``n_values`` and the exact quartiles, interpolated between places, to every row of a group."""
    whole = Window.partitionBy(*group)
    upto = F.sum("n").over(whole.orderBy("least").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumns({"n_values": F.sum("n").over(whole), "_upto": upto})
    missed = F.raise_error(F.lit("a quartile fell outside its bracket"))
    own = F.when(F.col("kept"), F.col("least")).otherwise(missed)
    sides = {}
    for name, p in QUARTILES.items():
        place = (F.col("n_values") - 1) * F.lit(p)
        for side, index in (("low", F.floor(place)), ("high", F.ceil(place))):
            here = (F.col("_upto") - F.col("n") <= index) & (index < F.col("_upto"))
            sides[f"_{name}_{side}"] = F.max(F.when(here, own)).over(whole)
    placed = placed.withColumns(sides)
    found = {}
    for name, p in QUARTILES.items():
        place, low, high = (F.col("n_values") - 1) * F.lit(p), F.col(f"_{name}_low"), F.col(f"_{name}_high")
        found[name] = low + (high - low) * (place - F.floor(place))
    return placed.withColumns(found).drop("_upto", *sides)


# ---- hashes


def first_by_hash(hashed: DataFrame, by: Sequence[str], wanted: Column, name: str = "is_first") -> DataFrame:
    """Adds ``name``, true for the first rows of each class in the order of ``_hash`` (32 hex digits).

    ``wanted`` is their number, over ``n``, the rows of the class. Counts per class and leading digits
    tell the digits of the last hash that belongs to them, four at a time and only as many as there are rows to tell apart;
    then a filter marks the rows. Rows with just this hash are equal in their keys, and any of them count.
    """
    ends = last_hashes(hashed.select(class_key(by).alias("_k"), "_hash"), wanted)
    if not ends:
        return hashed.withColumn(name, F.lit(False))
    key = class_key(by)
    last = F.element_at(F.create_map(*[F.lit(x) for k, (end, _, _) in ends.items() for x in (k, end)]), key)
    if all(take == n for _, take, n in ends.values()):
        return hashed.withColumn(name, F.coalesce(F.col("_hash") <= last, F.lit(False)))
    take = F.element_at(F.create_map(*[F.lit(x) for k, (_, n, _) in ends.items() for x in (k, n)]), key)
    at_end = F.coalesce(F.col("_hash") == last, F.lit(False))
    others = hashed.where(~at_end).withColumn(name, F.coalesce(F.col("_hash") < last, F.lit(False)))
    ranked = F.row_number().over(Window.partitionBy(*by, "_hash").orderBy("_hash"))
    return others.unionByName(hashed.where(at_end).withColumn(name, ranked <= take))


def last_hashes(rows: DataFrame, wanted: Column) -> dict[str, tuple[str, int, int]]:
    """Per class ``_k``: the last hash that is wanted, how many of its rows are, and how many there are."""
    todo: dict[str, tuple[str, int]] = {}  # class: digits so far, rows still wanted behind smaller hashes
    done: dict[str, tuple[str, int, int]] = {}
    for depth in range(0, HEX_DIGITS, DIGITS):
        part = rows
        if depth:
            digits = F.element_at(F.create_map(*[F.lit(x) for k, (d, _) in todo.items() for x in (k, d)]), F.col("_k"))
            part = rows.where(F.substring("_hash", 1, depth) == digits)
        bins = part.groupBy("_k", F.substring("_hash", depth + 1, DIGITS).alias("_digits")).agg(
            F.count("*").alias("_n"), F.min("_hash").alias("_least"), F.max("_hash").alias("_most")
        )
        whole = Window.partitionBy("_k")
        upto = F.sum("_n").over(whole.orderBy("_digits").rowsBetween(Window.unboundedPreceding, 0))
        bins = bins.withColumns({"n": F.sum("_n").over(whole), "_upto": upto})
        if depth:
            goal = F.element_at(F.create_map(*[F.lit(x) for k, (_, left) in todo.items() for x in (k, left)]), F.col("_k"))
        else:
            goal = F.least(wanted.cast("long"), F.col("n"))
        crossing = bins.withColumn("_goal", goal.cast("long")).where("_upto - _n < _goal and _goal <= _upto")
        found = crossing.limit(MOST_CLASSES + 1).collect()
        if len(found) > MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes")
        todo = {}
        for r in found:
            left = r["_goal"] - (r["_upto"] - r["_n"])
            if left == r["_n"]:
                # All rows of the bin are wanted: its largest hash ends them, with no row at it left out.
                done[r["_k"]] = (r["_most"], left, left)
            elif r["_least"] == r["_most"]:
                done[r["_k"]] = (r["_most"], left, r["_n"])
            else:
                todo[r["_k"]] = (r["_least"][: depth + DIGITS], left)
        if not todo:
            break
    return done
