"""Landed files taken in once each: an append-only ledger whose rows commit the batches of a table.

A run lists the landed files, leaves out those that the ledger holds with the same size and time, and writes the rows
of the others as a batch of its own, ``batch=<name>``. Only then it appends the batch's files to the ledger. That
append is the commit: readers see batches that the ledger names, so a run that dies before it leaves rows
that nobody reads, and its files are taken by the next run. A file that was landed again with another
size or time is taken again, and its new rows replace the old ones: readers see each file's last version.

One run at a time may write to a ledger.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.fixed_values import RAW_FILE_GLOB, RAW_SCHEMA
from pageflow.functions.running import materialize
from pageflow.sources.raw import CSV_OPTIONS, add_file_time
from pageflow.sources.tables import path_exists, write_table

LEDGER_SCHEMA = "file_name string, file_bytes long, file_modified timestamp, batch string, taken_at timestamp"
FILE = ("file_name", "file_bytes", "file_modified")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All files taken so far, one row per version; empty before the first run."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def landed_versions(spark: SparkSession, input_dir: str, glob: str = RAW_FILE_GLOB) -> DataFrame:
    """Name, size and time of every landed file; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(input_dir)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file_name"), F.col("length").alias("file_bytes"), F.col("modificationTime").alias("file_modified"))


def new_versions(landed: DataFrame, taken: DataFrame) -> DataFrame:
    """Landed files that were not taken with this size and time."""
    return landed.join(taken.select(*FILE), list(FILE), "left_anti")


def stage_batch(spark: SparkSession, input_dir: str, path: str, ledger: str, glob: str = RAW_FILE_GLOB) -> DataFrame | None:
    """Writes the rows of new files as a batch of the table and returns its ledger rows, not yet committed.

    None if there is nothing new. The list of new files is stored first, so files that land meanwhile wait for the next run.
    """
    batch = uuid.uuid4().hex
    new = new_versions(landed_versions(spark, input_dir, glob), read_ledger(spark, ledger))
    files = materialize(new.withColumns({"batch": F.lit(batch), "taken_at": F.current_timestamp()}))
    if files.isEmpty():
        return None
    lines = (
        spark.read.schema(RAW_SCHEMA).options(**CSV_OPTIONS).option("pathGlobFilter", glob).csv(input_dir)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )
    rows = lines.join(files.select("file_name", "batch"), "file_name").withColumn("source_file", F.col("file_name"))
    write_table(add_file_time(rows), path, mode="append", partition_by=("batch", "file_date"))
    return files


def commit_batch(files: DataFrame, ledger: str) -> None:
    """Appends the batch's files to the ledger, in one file and so at once."""
    files.coalesce(1).write.mode("append").parquet(ledger)


def take_new_files(spark: SparkSession, input_dir: str, path: str, ledger: str, glob: str = RAW_FILE_GLOB) -> bool:
    """Takes all files that have landed since the last run; False if there were none."""
    files = stage_batch(spark, input_dir, path, ledger, glob)
    if files is not None:
        commit_batch(files, ledger)
    return files is not None


def committed_rows(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Rows of the last committed version of every file, with ``file_name``; uncommitted batches are left out."""
    versions = read_ledger(spark, ledger).groupBy("file_name").agg(F.max_by("batch", F.struct("taken_at", "batch")).alias("batch"))
    rows = spark.read.parquet(path)
    return rows.join(versions, ["file_name", "batch"], "left_semi").drop("batch")
