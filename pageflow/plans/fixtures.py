"""Page-view logs derived from the ``events`` table, as input of the registered queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path
from pageflow.operators.cleaning import silver
from pageflow.operators.features import Windows

TRAIN = Windows.of("2024-01-01", "2024-01-23", "2024-01-24", "2024-01-27")
TEST = Windows.of("2024-01-05", "2024-01-27", "2024-01-28", "2024-01-30")
LATE_DAY = "2024-01-15"
LANGUAGES = ["English", "Italian", "French", "German", "Spanish"]
SILVER_COLUMNS = [
    "domain_code",
    "page_title",
    "count_views",
    "file_date",
    "file_time",
    "language",
    "database_name",
    "is_mobile",
    "namespace",
]
RAW_COLUMNS = ["domain_code", "page_title", "count_views", "total_response_size", "file_date", "file_time"]

# Constant arrays and maps rather than CASE arms: the whole cleaning step is compiled into one
# method together with these, and the JVM does not optimize methods beyond 8,000 bytes. The one
# field of props ({"k": n}) is cut out as text, as filters evaluate the title several times.
DOMAIN = """
if(event_id % 101 = 0, null, concat(
  element_at(array('en', 'it', 'fr', 'de', 'es', 'it', 'commons', 'xx', 'en'), cast(user_id % 9 as int) + 1),
  coalesce(
    map('view', '', 'click', '.m', 'purchase', '.b', 'signup', '.m.voy')[event_type],
    element_at(array('.q', '.n', '.s', '.v', '.d', '.w', '.wd', '.f'),
               cast(user_id % 7 + if(user_id % 7 = 6, user_id % 2, 0) as int) + 1))))"""
TITLE = """
if(event_id % 97 = 0, '-', if(event_id % 103 = 0, null, concat(
  element_at(array('', 'Special:', 'Talk:', 'User talk:', 'User_talk:', 'Star_Trek:_', 'File:A:', ''),
             cast(user_id % 8 as int) + 1),
  'P', user_id, '_', cast(trim(trailing '}' from substring_index(props, ':', -1)) as bigint) % (1 + user_id % 6))))"""
VIEWS = "if(event_id % 89 = 0, -1L, cast(floor(value) as bigint))"


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-like rows, with the time they came in."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.expr(DOMAIN).alias("domain_code"),
        F.expr(TITLE).alias("page_title"),
        F.expr(VIEWS).alias("count_views"),
        F.expr("cast(floor(value * 100) as bigint)").alias("total_response_size"),
        F.expr("cast(ts as date)").alias("file_date"),
        F.expr("date_format(ts, 'HH:00:00')").alias("file_time"),
        F.expr("cast(ts as timestamp)").alias("ingestion_time"),
    )


def silver_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(page_log(spark, sf_dir)).select(*SILVER_COLUMNS)


def log_lines(log: DataFrame) -> DataFrame:
    """Rows as raw log lines next to the name of the hourly file they belong to."""
    title = F.replace(F.coalesce("page_title", F.lit("")), F.lit(" "), F.lit("_"))
    name = F.concat(
        F.lit("pageviews-"), F.date_format("file_date", "yyyyMMdd"), F.lit("-"), F.replace("file_time", F.lit(":"))
    )
    line = F.concat_ws(" ", F.coalesce("domain_code", F.lit("")), title, "count_views", "total_response_size")
    return log.select(line.alias("value"), name.alias("source_file"))


def land_raw_files(spark: SparkSession, lines: DataFrame) -> str:
    """Writes lines as gzip files named by hour into a new folder and returns its path.

    Spark names output files itself, so each part is given its hourly name after the write.
    """
    stage, landing = scratch_path(spark, "stage"), scratch_path(spark, "landing")
    lines.hint("rebalance", F.col("source_file")).write.partitionBy("source_file").option("compression", "gzip").text(stage)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = jvm_path(stage).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(jvm_path(landing))
    for part, status in enumerate(system.globStatus(jvm_path(f"{stage}/source_file=*/*.gz"))):
        hour = status.getPath().getParent().getName().removeprefix("source_file=")
        system.rename(status.getPath(), jvm_path(f"{landing}/{hour}-{part:05d}.gz"))
    return landing
