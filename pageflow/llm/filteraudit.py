"""How filters overlap: what each removes at each place of every order, by recursive enumeration.

Documents are first reduced to cells: how many of a part fail exactly this set of filters, the set being
the bits of one number. A recursive query then extends filter prefixes by each unused letter, carrying
the bits applied so far next to every mask that occurs; each level says for its step which masks it
removes, which were gone before, and which it leaves. Sums of the cells over these are the measures. The
recursion works on masks alone (at most 2**n of them for n filters), whatever the number of parts.

A document is a duplicate if a row with a smaller id has the same text. Rows are counted per
text and id, then per text, so a text that a third of all rows share puts no more rows into a task than
another.

Results: a NULL text counts as empty and a NULL part as the empty string; a NULL id is no duplicate and
makes none; rows that repeat the smallest id of a text are no duplicates; a document counts as good or
toxic if any of its label rows says so; unlabelled documents are neither; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm.common import stored, text_of

WORDS = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "[#$%&*|]"
DUPLICATE = "E"
MOST_FILTERS = 6

PREFIXES = """
    WITH RECURSIVE steps(prefix, step, before, bit, mask) AS (
        SELECT CAST('' AS STRING), 0, 0, 0, mask FROM {cells}
        UNION ALL
        SELECT concat(prefix, letter), step + 1, before | bit, letter_bit, mask FROM (
            SELECT prefix, step, before, bit, mask, inline(unused) AS (letter, letter_bit) FROM (
                SELECT s.*, filter(l.letters, x -> ((s.before | s.bit) & x.bit) = 0) AS unused
                FROM steps s JOIN {cells} l ON s.mask = l.mask
            )
        )
    )
    SELECT prefix, step, mask,
        (mask & (before | bit)) = 0 AS is_kept,
        (mask & before) = 0 AND (mask & bit) <> 0 AS is_removed,
        (mask & before) <> 0 AND (mask & bit) <> 0 AS is_redundant,
        mask = bit AS is_unique
    FROM steps WHERE step > 0
"""


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of a text: few words, few different words, many capitals, odd symbols."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n, different = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(text) - F.octet_length(F.translate(text, CAPITALS, ""))
    return {
        "A": n < 200,
        "B": 100 * different < 50 * n,
        "C": 100 * capitals > 3 * F.char_length(text),
        "D": text.rlike(SYMBOLS),
    }


def mask_cells(
    docs: DataFrame, labels: DataFrame, bits: Mapping[str, int], filters: Mapping[str, Column], id_col: str, text_col: str, part_col: str
) -> DataFrame:
    """Rows per part and mask of failed filters: ``n``, ``good`` and ``toxic`` among them."""
    flags = labels.groupBy(F.col(id_col).alias("_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    failed = sum((F.when(condition, F.lit(bits[letter])).otherwise(0) for letter, condition in filters.items()), F.lit(0))
    slim = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        failed.alias("mask"),
        F.unhex(F.sha2(text_of(text_col).cast("binary"), 256)).alias("_digest"),
    )
    known = slim.join(flags, "_id", "left").na.fill(False, ["good", "toxic"])
    if DUPLICATE not in bits:
        return _cells(known.withColumn("n", F.lit(1)))
    kind = ["_digest", "mask", "part", "good", "toxic"]
    per_id = known.groupBy("_id", *kind).agg(F.count("*").alias("n"))
    per_kind = per_id.groupBy(*kind, F.col("_id").isNull().alias("_null")).agg(
        F.sum("n").alias("n"), F.min("_id").alias("_least"), F.min_by("n", "_id").alias("_at_least")
    )
    # Few rows are left of a text: one for each part and label. The smallest id of them is the original.
    least = F.min("_least").over(Window.partitionBy("_digest"))
    firsts = F.when(F.col("_null"), F.col("n")).when(F.col("_least") == least, F.col("_at_least")).otherwise(F.lit(0))
    split = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("_firsts").alias("n")),
        F.struct((F.col("mask") + bits[DUPLICATE]).alias("mask"), (F.col("n") - F.col("_firsts")).alias("n")),
    )
    both = per_kind.withColumn("_firsts", firsts).select("part", "good", "toxic", F.inline(split))
    return _cells(both.where("n > 0"))


def _cells(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.groupBy("part", "mask").agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic")
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    duplicates: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """A row per part, order of the filters and step in it: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``filters`` maps letters to failure conditions over ``docs`` (default: ``text_filters``); ``duplicates``
    adds the filter E. At most six filters: orders grow as the factorial.
    """
    chosen = dict(text_filters(text_of(text_col)) if filters is None else filters)
    letters = [*chosen, *([DUPLICATE] if duplicates else [])]
    if not 1 <= len(letters) == len(set(letters)) <= MOST_FILTERS or any(len(x) != 1 for x in letters):
        raise ValueError(f"one to {MOST_FILTERS} filters are named by letters of their own, not {letters}")
    spark, size = docs.sparkSession, len(letters)
    bits = {letter: 1 << at for at, letter in enumerate(letters)}
    cells = stored(mask_cells(docs, labels, bits, chosen, id_col, text_col, part_col), "mask-cells")

    named = F.array(*[F.struct(F.lit(letter).alias("letter"), F.lit(bit).alias("bit")) for letter, bit in bits.items()])
    steps = stored(spark.sql(PREFIXES, cells=cells.select("mask").distinct().withColumn("letters", named)), "filter-steps")

    def total(flag: str, of: str = "n") -> Column:
        return F.sum(F.when(F.col(flag), F.col(of)).otherwise(0))

    measured = cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step").agg(
        total("is_kept").alias("kept"),
        total("is_removed").alias("removed"),
        total("is_redundant").alias("redundant"),
        total("is_unique").alias("unique_fails"),
        total("is_removed", "good").alias("good_lost"),
        total("is_removed", "toxic").alias("toxic_lost"),
    )  # steps has no more than 2**6 masks times 1,956 prefixes
    measured = measured.withColumn("letter", F.substring("prefix", -1, 1))
    ways = F.element_at(F.array(*[F.lit(math.factorial(size - k)) for k in range(1, size + 1)]), F.col("step"))
    shares = measured.groupBy("part", "letter").agg(F.sum(F.col("removed") * ways).alias("shapley"))
    orders = steps.where(F.col("step") == size).select(F.col("prefix").alias("filter_order")).distinct()
    places = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step"))
    places = places.withColumn("prefix", F.col("filter_order").substr(F.lit(1), F.col("step"))).drop("step")
    return (
        measured.join(F.broadcast(places), "prefix")
        .join(shares, ["part", "letter"])
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )
