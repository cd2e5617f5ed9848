"""Cut points in the lineage, and running totals that never put a whole group into one task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh local one only in local mode without it."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = configured or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pageflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return configured or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/pageflow-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder once, so that later steps all see the same rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def running_totals(
    df: DataFrame,
    order_by: Sequence[str | Column],
    sums: Mapping[str, str | Column],
    partition_by: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """Adds inclusive running totals (output name -> summand) in the given order, per group.

    A plain window would need a group in one task. Here rows are range-partitioned by group and
    order, so a large group spans many partitions; totals per partition (at most one row for each
    partition and group) give the offsets, and only the rows of a partition are summed in order.
    The ranges come from a sample, hence the rows are written once before they are read twice.
    The order must be total within a group. ``tasks``, if given, bounds the tasks that write the ranges.
    """
    summed = df.select("*", *[_column(c).alias(f"_of_{name}") for name, c in sums.items()])
    ranged = summed.repartitionByRange(*[F.col(c) for c in partition_by], *order_by)
    ranged = ranged.withColumn("_part", F.spark_partition_id())
    fixed = materialize(ranged if tasks is None else ranged.coalesce(tasks))

    per_part = fixed.groupBy(*partition_by, "_part").agg(
        *[F.sum(f"_of_{name}").alias(f"_sum_{name}") for name in sums]
    )
    earlier = Window.partitionBy(*partition_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        *[F.col(c).alias(f"_by_{c}") for c in partition_by],
        F.col("_part").alias("_by_part"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
    )
    matches = F.col("_part") == F.col("_by_part")
    for c in partition_by:
        matches = matches & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = (
        Window.partitionBy(*partition_by, "_part")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = {n: F.col(f"_before_{n}") + F.sum(f"_of_{n}").over(inside) for n in sums}
    return fixed.join(offsets, matches).select(*df.columns, *[total.alias(n) for n, total in totals.items()])


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
