"""Connected components of a link table, by alternating large-star and small-star steps.

Each step gives every node the smallest node it is linked with, using one aggregation (combined inside
tasks, so a node with very many links is no hot spot) and one equal join. The number of rounds grows with
the logarithm of the longest chain. ``components_by_parts`` first lets every task turn the links it reads into stars, ``PART``
links at a time; where no more than ``PART`` links are left, one more pass of this kind over them ends the search without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import release, stored

# Links of which one task makes stars at once, two numbers each.
PART = 20_000


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node`` and the smallest node of its component, ``component``, for all nodes with links to others.

    NULL ends and links from a node to itself are ignored; repeated links count once; no links, no rows.
    """
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = stored(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(rounds):
        if _stars(edges):
            break
        release(links.sparkSession)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small-star: every node points at its smallest smaller neighbour, and so do its other ones
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def components_by_parts(links: DataFrame) -> DataFrame:
    """As ``components`` of the links (a, b)."""
    ends = links.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u <> v")
    edges = stored(contracted(ends), "links")
    if edges.count() > PART:
        return components(edges, "u", "v")
    few = stored(contracted(edges.coalesce(1), roots=True), "links")
    return few.select(F.col("u").alias("node"), F.col("v").alias("component"))


def contracted(edges: DataFrame, roots: bool = False) -> DataFrame:
    """Links (u, v) that join the same nodes: in every ``PART`` links of a task each node with the smallest of its component.

    The smallest ones get rows of their own with ``roots`` only.
    """
    size = PART

    def stars(parent: dict[int, int]) -> pa.RecordBatch:
        pairs = [(x, _root(parent, x)) for x in parent]
        pairs = [(x, y) for x, y in pairs if roots or x != y]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        held = 0
        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                if held == size:
                    yield stars(parent)
                    parent, held = {}, 0
                x, y = _root(parent, u), _root(parent, v)
                parent[max(x, y)] = min(x, y)
                held += 1
        if parent:
            yield stars(parent)

    return edges.mapInArrow(run, "u long, v long")


def _root(parent: dict[int, int], x: int) -> int:
    """The smallest node known to be joined with x; the way there is halved."""
    parent.setdefault(x, x)
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _stars(edges: DataFrame) -> bool:
    """Whether every node either points at one node or is pointed at."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.where("up > 1 or (up = 1 and down = 1)").head(1)
