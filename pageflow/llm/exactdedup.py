"""Exact deduplication by a 128-bit content hash, with bytes compared inside the groups.

Hashes are counted without texts first. Only texts of hashes that occur more than once are compared:
they are grouped by hash and whole text, which combines copies inside each task before the shuffle,
and each row gets its group by an equal join that adaptive execution splits where a group is large.

Results: NULL is the empty text; the largest id of a group stays (or the smallest, by ``keep``), a NULL
id only if the group has no other; repeated rows of one id share its fate; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import stored, text_of


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hashed: Callable[[Column], Column] = hash128,
) -> DataFrame:
    """One row per document: id, the id that stays, size of its group, whether it stays, SHA-256 of its text."""
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    keyed = rows.withColumn("_hash", hashed(F.col("_text")))
    sizes = keyed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")

    alone = keyed.select("_id", "_hash", F.sha2("_text", 256).alias("text_sha256")).join(sizes, "_hash", "left_anti")
    alone = alone.select("_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")

    members = stored(keyed.join(sizes, "_hash"), "exact-members")
    pick = {"smallest": F.min, "largest": F.max}[keep]
    classes = members.groupBy("_hash", "_text").agg(pick("_id").alias("keep_id"), F.count("*").alias("group_size"))
    grouped = members.join(classes, ["_hash", "_text"]).select(
        "_id", "keep_id", "group_size", F.sha2("_text", 256).alias("text_sha256")
    )
    return alone.unionByName(grouped).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
