"""Partitioned columnar tables below plain paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pageflow.functions.fixed_values import MAX_RECORDS_PER_FILE


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] = "file_date",
    max_records: int = MAX_RECORDS_PER_FILE,
    only_partitions: bool = False,
    rebalance: bool = True,
) -> None:
    """Writes a snappy Parquet table.

    ``only_partitions`` restricts an overwrite to the partitions that occur in ``df``. Rows are
    rebalanced by the partition columns first: small partitions get few files, and adaptive
    execution splits one that holds much of the data over several tasks.
    """
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    rows = df.hint("rebalance", *[F.col(c) for c in columns]) if rebalance else df
    (
        rows.write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records)
        .option("partitionOverwriteMode", "dynamic" if only_partitions else "static")
        .partitionBy(*columns)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Reads a table; with a schema, partition columns get back their types and their place.

    Without one, a BIGINT partition column would come back as INT, and last.
    """
    if schema is None:
        return spark.read.parquet(path)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(wanted).parquet(path).select(*wanted.fieldNames())


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop(spark, path)
    return system.exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    system, target = _hadoop(spark, path)
    system.delete(target, True)


def table_bytes(spark: SparkSession, path: str) -> int:
    system, target = _hadoop(spark, path)
    return system.getContentSummary(target).getLength()


def require_paths(spark: SparkSession, *paths: str) -> None:
    """Raises FileNotFoundError naming every table path that does not exist."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing tables: {', '.join(missing)}; run the earlier steps first")


def split_by_language(
    df: DataFrame, languages: str | Sequence[str] = "English", path: str | None = None
) -> dict[str, DataFrame]:
    """One DataFrame per language.

    With a path, all languages go into one table partitioned by language and day, written in one
    pass, and each returned DataFrame reads its own partitions only.
    """
    names = [languages] if isinstance(languages, str) else list(languages)
    chosen = df.where(F.col("language").isin(names))
    if path is not None:
        write_table(chosen, path, partition_by=("language", "file_date"))
        chosen = read_table(df.sparkSession, path, df.schema)
    return {name: chosen.where(F.col("language") == name) for name in names}


def set_row_counts(**sets: DataFrame) -> DataFrame:
    """Row count of each named set, as one table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("set_name"), "n_rows")
        for name, df in sets.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result
