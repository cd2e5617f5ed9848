"""Late data and file layout of partitioned tables."""

from __future__ import annotations

import datetime
import functools
import logging
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pageflow.functions.fixed_values import MAX_RECORDS_PER_FILE
from pageflow.functions.running import materialize, scratch_path
from pageflow.operators.features import to_day
from pageflow.sources.tables import drop_path, path_exists, read_table, table_bytes, write_table

log = logging.getLogger(__name__)

TARGET_FILE_BYTES = 256 * 1024 * 1024


def dedup_latest(df: DataFrame, key_cols: Sequence[str], version: str = "ingestion_time") -> DataFrame:
    """The newest row of each key; rows of equal age are told apart by their other columns.

    Ranks are cut at 1, so each task sends one row per key however many copies it holds.
    """
    others = [F.desc_nulls_last(c) for c in df.columns if c not in (*key_cols, version)]
    newest_first = Window.partitionBy(*key_cols).orderBy(F.desc_nulls_last(version), *others)
    return df.withColumn("_rn", F.row_number().over(newest_first)).where("_rn = 1").drop("_rn")


def upsert_partition(
    spark: SparkSession,
    path: str,
    late: DataFrame,
    day: str | datetime.date,
    dedup_cols: Sequence[str],
    date_col: str = "file_date",
    version: str = "ingestion_time",
) -> None:
    """Merges late rows into one day of a table and rewrites that day alone.

    All late rows must be of that day. The merged day is first written as a table of its own in the
    shared folder; should the job die while it replaces the old files, that copy is complete.
    """
    day = to_day(day)
    late = materialize(late)
    if not late.where(~F.col(date_col).eqNullSafe(F.lit(day))).isEmpty():
        raise ValueError(f"late rows of other days than {day}")
    stored = read_table(spark, path).where(F.col(date_col) == F.lit(day))
    stage = scratch_path(spark, f"upsert-{day}")
    write_table(dedup_latest(stored.unionByName(late), dedup_cols, version), stage, partition_by=date_col)
    log.info("merged rows of %s for %s are in %s", day, path, stage)
    write_table(read_table(spark, stage), path, partition_by=date_col, only_partitions=True)
    drop_path(spark, stage)


def stage_late(
    spark: SparkSession,
    path: str,
    late: DataFrame,
    dedup_cols: Sequence[str],
    date_col: str = "file_date",
    version: str = "ingestion_time",
) -> str | None:
    """Writes the merged days of late rows of any days to a table in the shared folder and returns its path.

    The days come from the late rows, one row per day, and prune the stored table to their partitions. Stored rows whose
    key is not among the late rows keep their place and are not ranked: a semi and an anti join on the late
    keys tell them apart, where Spark puts a Bloom filter of the late keys before the shuffle by itself. Late rows without a
    day are an error; without late rows nothing is staged and the result is None.
    """
    late = materialize(late)
    days = [r[0] for r in late.select(F.col(date_col).cast("date")).distinct().collect()]
    if None in days:
        raise ValueError("late rows without a day")
    if not days:
        return None
    keys = list(dict.fromkeys([date_col, *dedup_cols]))
    stored = read_table(spark, path).where(F.col(date_col).isin(days))
    late_keys = late.select(*[F.col(c).alias(f"_late_{c}") for c in keys]).distinct()
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_late_{c}"))
    touched = stored.join(late_keys, same, "left_semi")
    untouched = stored.join(late_keys, same, "left_anti")
    merged = dedup_latest(touched.unionByName(late), keys, version).unionByName(untouched)
    stage = scratch_path(spark, "upsert-days")
    write_table(merged, stage, partition_by=date_col)
    log.info("merged rows of %d days for %s are in %s", len(days), path, stage)
    return stage


def swap_staged(spark: SparkSession, path: str, stage: str, date_col: str = "file_date") -> None:
    """Replaces the days of a staged table in the table at ``path``; other days are not touched.

    Safe to repeat: should the job die in between, running it again with the same stage completes it.
    """
    write_table(read_table(spark, stage), path, partition_by=date_col, only_partitions=True)


def upsert_late(
    spark: SparkSession,
    path: str,
    late: DataFrame,
    dedup_cols: Sequence[str],
    date_col: str = "file_date",
    version: str = "ingestion_time",
) -> None:
    """Merges late rows of any number of days into a table and rewrites these days alone.

    Per day and key the newest row stays. Days are staged complete before the first file is replaced (``stage_late``,
    ``swap_staged``), so no day is ever lost.
    """
    stage = stage_late(spark, path, late, dedup_cols, date_col, version)
    if stage is not None:
        swap_staged(spark, path, stage, date_col)
        drop_path(spark, stage)


def cluster_rewrite(
    spark: SparkSession,
    path: str,
    dest: str,
    by: Sequence[str] = ("page_title", "count_views"),
    date_col: str = "file_date",
    days: tuple[str | datetime.date, str | datetime.date] | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    max_records: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Writes a copy of a table in few, clustered files, so that scans can skip by min/max.

    Rows are sorted by the columns in turn, every day on its own, as a file holds one day anyway. A day that fills one
    file is sorted in one task. Days of more than ``target_bytes`` or ``max_records`` are cut into ranges; all columns take
    part in the bounds, so that many rows with one title still spread over several files. So a task sorts no more than about
    one file's rows. ``days`` copies these days (first and last, inclusive) alone. Readers move to the copy when it is
    complete: plain files offer no safe swap in place.
    """
    if dest.rstrip("/") == path.rstrip("/"):
        raise ValueError("the clustered copy needs a path of its own")
    rows = read_table(spark, path)
    if days is None:
        size = table_bytes(spark, path)
    else:
        first, last = [to_day(d) for d in days]
        rows = rows.where(F.col(date_col).between(F.lit(first), F.lit(last)))
        parts = [f"{path}/{date_col}={first + datetime.timedelta(n)}" for n in range((last - first).days + 1)]
        size = sum(table_bytes(spark, part) for part in parts if path_exists(spark, part))
    order = [date_col, *by]
    rest = [c for c in rows.columns if c not in order]
    counts = rows.groupBy(F.col(date_col).alias("_day")).agg(F.count("*").alias("_n")).collect()
    total = sum(r["_n"] for r in counts)
    files = {r["_day"]: max(math.ceil(size * r["_n"] / total / target_bytes), math.ceil(r["_n"] / max_records)) for r in counts}
    whole = [day for day, n in files.items() if n == 1]
    ranges = sum(n for n in files.values() if n > 1)
    schema = StructType([StructField("_day", rows.schema[date_col].dataType), StructField("_place", LongType())])
    places = F.broadcast(spark.createDataFrame([(day, place) for place, day in enumerate(whole)], schema))  # a row per day
    same = rows[date_col].eqNullSafe(places["_day"])
    parts = []
    if whole:
        parts.append(rows.join(places, same).repartitionById(len(whole), F.col("_place").cast("int")).select(*rows.columns))
    if ranges:
        parts.append(rows.join(places, same, "left_anti").repartitionByRange(ranges, *order, *rest))
    placed = functools.reduce(DataFrame.unionByName, parts) if parts else rows
    write_table(placed.sortWithinPartitions(*order), dest, partition_by=date_col, max_records=max_records, rebalance=False)
