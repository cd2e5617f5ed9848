"""Landed files are taken once, whatever happens between the write and the commit."""

from __future__ import annotations

import gzip
import os

import pytest

from pageflow.functions.running import scratch_path
from pageflow.sources import ledger


@pytest.fixture()
def places(spark, tmp_path):
    return str(tmp_path), scratch_path(spark, "bronze"), scratch_path(spark, "ledger")


def land(folder: str, hour: int, *titles: str, stamp: int | None = None) -> None:
    path = f"{folder}/pageviews-20250101-{hour:02d}0000.gz"
    with gzip.open(path, "wt") as file:
        file.writelines(f"en {t} 1 0\n" for t in titles)
    if stamp:
        os.utime(path, (stamp, stamp))


def titles(spark, path: str, log: str) -> list[str]:
    spark.catalog.refreshByPath(path)
    spark.catalog.refreshByPath(log)
    return sorted(r.page_title for r in ledger.committed_rows(spark, path, log).collect())


def test_each_file_once(spark, places):
    folder, path, log = places
    land(folder, 0, "a", "b")
    land(folder, 1, "c")
    with open(f"{folder}/notes.txt", "w") as other:
        other.write("en x 1 0\n")
    assert ledger.take_new_files(spark, folder, path, log)
    assert titles(spark, path, log) == ["a", "b", "c"]
    assert not ledger.take_new_files(spark, folder, path, log)
    land(folder, 2, "d", "a")
    assert ledger.take_new_files(spark, folder, path, log)
    assert titles(spark, path, log) == ["a", "a", "b", "c", "d"]
    taken = ledger.read_ledger(spark, log)
    assert taken.count() == 3 and taken.select("batch").distinct().count() == 2


def test_a_changed_file_replaces_its_rows(spark, places):
    folder, path, log = places
    land(folder, 0, "a", "b", stamp=1_700_000_000)
    land(folder, 1, "c")
    ledger.take_new_files(spark, folder, path, log)
    land(folder, 0, "a", "new", stamp=1_700_000_100)
    assert ledger.take_new_files(spark, folder, path, log)
    assert titles(spark, path, log) == ["a", "c", "new"]
    assert ledger.read_ledger(spark, log).count() == 3


def test_a_run_that_dies_before_the_commit_leaves_nothing(spark, places):
    folder, path, log = places
    land(folder, 0, "a")
    ledger.take_new_files(spark, folder, path, log)
    land(folder, 1, "b")
    assert ledger.stage_batch(spark, folder, path, log) is not None  # and no commit
    assert titles(spark, path, log) == ["a"]
    assert ledger.take_new_files(spark, folder, path, log)
    assert titles(spark, path, log) == ["a", "b"]


def test_an_empty_folder(spark, places):
    folder, path, log = places
    assert not ledger.take_new_files(spark, folder, path, log)
    assert ledger.read_ledger(spark, log).count() == 0
