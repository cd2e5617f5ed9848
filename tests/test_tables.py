"""Tables on disk: layout, late data, clustering, guards."""

from __future__ import annotations

import datetime
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pageflow.functions.running import scratch_path
from pageflow.operators.maintenance import cluster_rewrite, stage_late, swap_staged, upsert_late, upsert_partition
from pageflow.plans.fixtures import LATE_DAY, silver_log
from pageflow.sources import landing, tables
from pageflow.sources.session import create_spark

DAY = datetime.date.fromisoformat(LATE_DAY)
KEYS = ["page_title", "domain_code", "namespace", "file_time"]


@pytest.fixture()
def table(spark):
    rows = silver_log(spark, "/root/testdata/sf0.001").withColumn("ingestion_time", F.lit(1))
    path = scratch_path(spark, "test")
    tables.write_table(rows, path)
    return path, tables.read_table(spark, path, rows.schema)


def content(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def test_rewrite_does_not_double_rows(spark, table):
    path, rows = table
    before = content(rows)
    copy = scratch_path(spark, "copy")
    for mode, times in (("overwrite", 1), ("overwrite", 1), ("append", 2)):
        tables.write_table(rows, copy, mode=mode)
        assert len(content(tables.read_table(spark, copy))) == times * len(before)


def test_partition_types_come_back(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "x int, days_active bigint, y string")
    path = scratch_path(spark, "types")
    tables.write_table(rows, path, partition_by="days_active")
    assert tables.read_table(spark, path, rows.schema).schema == rows.schema


def test_upsert_is_idempotent_and_local(spark, table):
    path, rows = table
    others = content(rows.where(F.col("file_date") != F.lit(DAY)))
    late = rows.where(F.col("file_date") == F.lit(DAY)).withColumns(
        {"count_views": F.col("count_views") + 1, "ingestion_time": F.lit(2)}
    )
    new = late.limit(1).withColumn("page_title", F.lit("brand new"))
    arrived = scratch_path(spark, "late")
    tables.write_table(late.unionByName(new), arrived)
    late = tables.read_table(spark, arrived)
    states = []
    for _ in range(2):
        upsert_partition(spark, path, late, LATE_DAY, KEYS)
        spark.catalog.refreshByPath(path)
        now = tables.read_table(spark, path, rows.schema)
        assert content(now.where(F.col("file_date") != F.lit(DAY))) == others
        states.append(content(now.where(F.col("file_date") == F.lit(DAY))))
    assert states[0] == states[1]
    assert any("brand new" in row for row in states[0])
    assert all(r.ingestion_time == 2 for r in now.where(F.col("file_date") == F.lit(DAY)).collect())


def test_upsert_refuses_other_days(spark, table):
    path, rows = table
    before = content(rows)
    with pytest.raises(ValueError):
        upsert_partition(spark, path, rows, LATE_DAY, KEYS)
    assert content(tables.read_table(spark, path, rows.schema)) == before


def late_of(spark, rows, days):
    late = rows.where(F.col("file_date").isin(days)).withColumns(
        {"count_views": F.col("count_views") + 1, "ingestion_time": F.lit(2)}
    )
    arrived = scratch_path(spark, "late")
    tables.write_table(late, arrived)
    return tables.read_table(spark, arrived)


def files_of(path):
    """Content of the data files of every day."""
    return {day.name: sorted(f.read_bytes() for f in day.glob("*.parquet")) for day in Path(path).glob("file_date=*")}


def test_upsert_of_many_days(spark, table):
    """The same as one call per day; untouched days keep their very files; a key that only one side has stays."""
    path, rows = table
    days = [DAY, DAY + datetime.timedelta(3), DAY + datetime.timedelta(9)]
    late = late_of(spark, rows, days).where(F.col("file_time") >= "12:00:00")
    new = late.limit(1).withColumn("page_title", F.lit("brand new"))
    late = late.unionByName(new.withColumn("file_date", F.lit(datetime.date(2030, 1, 1))))
    single = scratch_path(spark, "single")
    tables.write_table(rows.dropDuplicates([*KEYS, "file_date"]), single)
    many = scratch_path(spark, "many")
    tables.write_table(tables.read_table(spark, single, rows.schema), many)
    before = files_of(many)
    for day in days:
        upsert_partition(spark, single, late.where(F.col("file_date") == F.lit(day)), day, KEYS)
    upsert_late(spark, many, late, KEYS)
    for p in (single, many):
        spark.catalog.refreshByPath(p)
    after = tables.read_table(spark, many, rows.schema)
    assert content(after.where("file_date < '2030-01-01'")) == content(tables.read_table(spark, single, rows.schema))
    assert [r.page_title for r in after.where("file_date >= '2030-01-01'").collect()] == ["brand new"]
    touched = {f"file_date={d}" for d in days}
    assert {k: v for k, v in files_of(many).items() if k in before and k not in touched} == {k: v for k, v in before.items() if k not in touched}


def test_upsert_survives_a_crash_between_stage_and_swap(spark, table):
    path, rows = table
    before = content(rows)
    late = late_of(spark, rows, [DAY, DAY + datetime.timedelta(1)])
    stage = stage_late(spark, path, late, KEYS)
    assert content(tables.read_table(spark, path, rows.schema)) == before
    states = []
    for _ in range(2):  # the swap may be run again
        swap_staged(spark, path, stage)
        spark.catalog.refreshByPath(path)
        states.append(content(tables.read_table(spark, path, rows.schema)))
    assert states[0] == states[1] != before


def test_upsert_of_odd_rows(spark, table):
    path, rows = table
    before = content(rows)
    upsert_late(spark, path, rows.where("false"), KEYS)
    assert content(tables.read_table(spark, path, rows.schema)) == before
    with pytest.raises(ValueError, match="without a day"):
        upsert_late(spark, path, rows.limit(1).withColumn("file_date", F.lit(None).cast("date")), KEYS)


def test_clustering_keeps_rows_and_narrows_files(spark):
    # One title holds a third of the rows.
    rows = spark.range(30_000).select(
        F.lit(DAY).alias("file_date"),
        F.when(F.col("id") % 3 == 0, "Main").otherwise(F.concat(F.lit("P"), F.md5(F.col("id").cast("string")))).alias("page_title"),
        (F.hash("id") % 1000 + 1000).cast("bigint").alias("count_views"),
    )
    path, dest = scratch_path(spark, "flat"), scratch_path(spark, "clustered")
    tables.write_table(rows.repartition(8), path, rebalance=False)
    cluster_rewrite(spark, path, dest, target_bytes=tables.table_bytes(spark, path) // 8)
    after = tables.read_table(spark, dest)
    assert content(after) == content(tables.read_table(spark, path))

    def overlap(df):
        files = df.groupBy("_metadata.file_path").agg(
            F.min("page_title").alias("low"), F.max("page_title").alias("high"), F.count("*").alias("n")
        ).collect()
        probes = [f"P{i:x}" for i in range(16)]
        return sum(f.low <= p <= f.high for f in files for p in probes) / len(files), max(f.n for f in files)

    flat, _ = overlap(spark.read.parquet(path))
    clustered, largest = overlap(spark.read.parquet(dest))
    assert clustered < 0.7 * flat
    assert largest < 30_000 / 3
    with pytest.raises(ValueError):
        cluster_rewrite(spark, path, path)


def test_clustering_of_days_sizes_files_by_these_days(spark):
    """One of three days of equal size is written as a third of the files."""
    rows = spark.range(9_000).select(
        F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("file_date"),
        F.md5(F.col("id").cast("string")).alias("page_title"),
        F.col("id").alias("count_views"),
    )
    path, dest = scratch_path(spark, "flat"), scratch_path(spark, "clustered")
    tables.write_table(rows, path)
    cluster_rewrite(spark, path, dest, days=(DAY, DAY), target_bytes=tables.table_bytes(spark, path) // 6 + 1)
    after = spark.read.parquet(dest)
    assert after.count() == 3_000 and len(after.inputFiles()) == 2


def test_clustering_sorts_no_more_than_a_file_in_a_task(spark):
    """Days of any size, one of them NULL: a small day is one file, a large one is cut at the records of a file."""
    rows = spark.range(12_000).select(
        F.when(F.col("id") >= 6_000, F.lit(DAY).cast("date")).when(F.col("id") >= 500, F.date_add(F.lit(DAY), (F.col("id") % 5 + 1).cast("int"))).alias("file_date"),
        F.md5(F.col("id").cast("string")).alias("page_title"),
        F.col("id").alias("count_views"),
    )
    path = scratch_path(spark, "flat")
    tables.write_table(rows, path)
    for max_records, tasks in ((1_000_000, 7), (2_000, 9)):
        dest = scratch_path(spark, "clustered")
        cluster_rewrite(spark, path, dest, max_records=max_records)
        after = tables.read_table(spark, dest)
        assert content(after) == content(tables.read_table(spark, path))
        by_task = defaultdict(list)
        for r in after.select("_metadata.file_name", "file_date", "page_title").collect():
            by_task[r.file_name.split("-")[1]].append(r)
        assert len(by_task) == tasks
        assert all(len({r.file_date for r in held}) == 1 for held in by_task.values())
        assert max_records > 6_000 or max(map(len, by_task.values())) < 3_000
        if max_records > 6_000:
            assert len(after.inputFiles()) == tasks
            assert all([r.page_title for r in held] == sorted(r.page_title for r in held) for held in by_task.values())


def test_language_tables_are_pruned(spark, table):
    _, rows = table
    parts = tables.split_by_language(rows, ["English", "Italian"], scratch_path(spark, "languages"))
    assert list(parts) == ["English", "Italian"]
    plan = parts["Italian"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(language" in plan
    assert parts["Italian"].select("language").distinct().collect()[0][0] == "Italian"
    assert content(parts["English"]) == content(tables.split_by_language(rows)["English"])


def test_missing_paths(spark, table):
    path, _ = table
    tables.require_paths(spark, path)
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tables.require_paths(spark, path, "/tmp/nowhere")


def test_inventory(spark, tmp_path):
    (tmp_path / "pageviews-20250101-000000.gz").write_bytes(b"12345")
    (tmp_path / "other.gz").write_bytes(b"1")
    listed = landing.landing_inventory(spark, str(tmp_path))
    assert [tuple(r) for r in listed.collect()] == [("pageviews-20250101-000000.gz", 5)]
    assert tuple(landing.landing_totals(listed).first()) == (1, 5)


def test_session_factory(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "777")
    try:
        assert create_spark() is not None
        assert spark.conf.get("spark.sql.shuffle.partitions") == "777"
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
