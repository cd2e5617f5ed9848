"""Raw hourly logs: space-separated text, one gzip file (or more) per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pageflow.functions.fixed_values import RAW_FILE_GLOB, RAW_FILE_PATTERN, RAW_SCHEMA

# Titles may hold any number of quote characters, so no character is a quote (or an escape).
CSV_OPTIONS = {"sep": " ", "quote": "", "escape": "", "mode": "PERMISSIVE"}


def raw_schema() -> StructType:
    return StructType.fromDDL(RAW_SCHEMA)


def is_log_file(file_name: Column) -> Column:
    return file_name.rlike(RAW_FILE_PATTERN)


def file_timestamp(file_name: Column) -> Column:
    """Timestamp in a name such as ``pageviews-20250101-130000.gz``; NULL when it is not one."""
    stamp = F.concat_ws("", F.substring(file_name, 11, 8), F.substring(file_name, 20, 6))
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))


def add_file_time(df: DataFrame, file_name: str = "source_file") -> DataFrame:
    """Keeps rows of log files and replaces the file name by ``file_date`` and ``file_time``."""
    stamp = file_timestamp(F.col(file_name))
    return df.where(is_log_file(F.col(file_name))).select(
        *[c for c in df.columns if c != file_name],
        F.to_date(stamp).alias("file_date"),
        F.date_format(stamp, "HH:mm:ss").alias("file_time"),
    )


def read_raw(spark: SparkSession, input_dir: str, schema: StructType | str = RAW_SCHEMA) -> DataFrame:
    """Scans a folder of raw logs under a fixed schema; other files are not even opened."""
    rows = (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("pathGlobFilter", RAW_FILE_GLOB)
        .csv(input_dir)
        .select("*", F.col("_metadata.file_name").alias("source_file"))
    )
    return add_file_time(rows)


def parse_lines(df: DataFrame, line: str = "value", schema: str = RAW_SCHEMA) -> DataFrame:
    """The same parse for log lines that already sit in a text column."""
    parsed = F.from_csv(F.col(line), F.lit(schema), CSV_OPTIONS)
    return df.select(*[c for c in df.columns if c != line], parsed.alias("_row")).select(
        "_row.*", *[c for c in df.columns if c != line]
    )
