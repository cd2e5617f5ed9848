"""What there is to fetch, and what has landed already."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import RAW_FILE_GLOB
from pageflow.sources.links import anchors


def link_harvest(pages: DataFrame, prefix: str, suffix: str, html: str = "html") -> DataFrame:
    """Anchor targets with the given start and end, one row per anchor, next to the other columns."""
    link = F.col("link")
    return anchors(pages, html).where(link.startswith(prefix) & link.endswith(suffix))


def pending_files(links: DataFrame, landed: DataFrame, name: str = "link") -> DataFrame:
    """Distinct links that have not landed yet."""
    return links.select(name).distinct().join(landed.select(name), name, "left_anti")


def landing_inventory(spark: SparkSession, input_dir: str, glob: str = RAW_FILE_GLOB) -> DataFrame:
    """Name and size of every landed file; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(input_dir)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("file_bytes"))
    )


def landing_totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("total_bytes")
    )
