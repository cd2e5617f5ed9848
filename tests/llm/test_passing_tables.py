"""Stored tables go when nothing reads them any more, and documents in files are sharded without a copy."""

from __future__ import annotations

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pageflow.llm import common, decontaminate, nearcopies, sharding


@pytest.fixture
def tables(tmp_path, monkeypatch):
    """Names of the tables in the folder, without their random part; fresh for each test."""

    def path(spark, name):
        return f"file://{tmp_path}/{name}-{uuid.uuid4().hex}"

    monkeypatch.setattr(common, "scratch_path", path)
    monkeypatch.setattr(corpus_pipeline, "scratch_path", path)
    return lambda: sorted(p.name.rpartition("-")[0] for p in tmp_path.iterdir())


def test_the_pipeline_keeps_one_table(spark, documents, tables, monkeypatch, tmp_path):
    seen = []

    def stage(at):
        def run(spark, docs, sf_dir):
            seen.append(tables())
            return common.stored(docs.withColumn(f"s{at}", F.lit(at)), f"work-{at}")

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(f"stage {k}", stage(k)) for k in range(3)])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: documents([(1, "a"), (2, None), (None, "b")]))
    got = corpus_pipeline.run(spark, "")
    assert seen == [[], ["corpus-stage-0"], ["corpus-stage-1"]] and tables() == ["corpus-stage-2"]
    assert Counter((r.doc_id, r.text, r.s0, r.s1, r.s2) for r in got.collect()) == Counter([(1, "a", 0, 1, 2), (2, None, 0, 1, 2), (None, "b", 0, 1, 2)])


def test_passing_tables_go_and_the_last_stay(spark, tables):
    with common.passing():
        with common.passing("b"):
            a = common.stored(spark.range(3), "a")
            b = common.stored(a.where("id > 0"), "b")
            assert tables() == ["a", "b"]
        assert tables() == ["b"] and b.count() == 2
    assert tables() == []
    with pytest.raises(ZeroDivisionError), common.passing():
        common.stored(spark.range(3), "a")
        raise ZeroDivisionError
    assert tables() == []
    common.stored(spark.range(3), "a")
    assert tables() == ["a"]


def test_operators_leave_only_what_their_results_read(spark, documents, odd, tables):
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(60)]
    rows = [(k, " ".join(base[:k] + ["x"] + base[k + 1 :])) for k in range(20)] + [(100 + d if d else d, t) for d, t in odd]
    near = nearcopies.near_copies(documents(rows), percent=80)
    assert tables() == ["near-empty", "near-members"]
    assert near.count() == len(rows) and near.where("_size = 0").count() == sum(not (t or "").strip() for _, t in rows)
    item = " ".join(f"q{k}" for k in range(40))
    found = decontaminate.leaks(documents([*rows, (500, f"before {item} after")]), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert tables() == ["near-empty", "near-members"]
    assert [r._id for r in found.collect()] == [500]


def test_documents_in_files_are_sharded_without_a_copy(spark, documents, odd, tables, tmp_path):
    rows = [(k, f"text {k}") for k in range(90)] + [(200 + k, f"copy {k % 9}") for k in range(60)] + [(7, "again")] * 5 + [(None, "copy 1")] * 3 + list(odd)
    whole = documents(rows, extra=True).withColumns({x: F.lit("x") for x in ("_at", "_file", "_metadata", "shard")})
    path = common.scratch_path(spark, "docs")
    whole.repartition(5).write.parquet(path)
    docs = spark.read.parquet(path)
    assert common.plain_files(docs) and not common.plain_files(whole) and not common.plain_files(docs.where("doc_id > 3"))
    got = sharding.balanced_shards(docs, shards=6, rounds=3, carry=True)
    assert tables() == ["docs", "shard-rows"]
    # The same rows by way of a copy, since they are filtered.
    copied = sharding.balanced_shards(docs.where(F.lit(True) | F.col("doc_id").isNull()), shards=6, rounds=3, carry=True)
    assert "shard-documents" in tables() and got.columns == copied.columns and set(docs.columns) < set(got.columns)
    key = [c for c in got.columns if c != "text"]
    assert Counter((r.text, *[r[c] for c in key]) for r in got.collect()) == Counter((r.text, *[r[c] for c in key]) for r in copied.collect())
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(rows)
    assert got.select("shard", "slot").distinct().count() == len(rows)
    twice = spark.read.parquet(path, path)
    assert sharding.balanced_shards(twice, shards=6, rounds=2, carry=True).count() == twice.count()
