"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages

MAX_ROUNDS = 60


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    ).first()
    return int(row[0]), int(row[1])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(stages: Stages, links: DataFrame) -> DataFrame:
    """Rows (id, component) for every id in the links (a, b): component is the smallest id.

    Every round is written to the shared folder; nothing but a count and a checksum reaches the
    driver. The last rounds' edges are stars, so each id but the smallest is one row.
    """
    edges = stages.put(links.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = _checksum(edges)
    for _ in range(MAX_ROUNDS):
        moved = _small_star(_large_star(edges)).filter("a <> b").distinct()
        following = stages.put(moved, "edges")
        stages.drop(edges)
        edges, before = following, seen
        seen = _checksum(edges)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    members = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id")).distinct()
    return members.unionByName(roots.select("id", F.col("id").alias("component")))
