"""Connected components of a graph of any size, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) of all nodes with an edge.

    ``edges`` has columns ``a`` and ``b`` of one type. In each round every node's larger neighbours,
    then its smaller ones, are tied to the smallest node it knows; rounds grow with the logarithm of
    the longest path. A round's edges are written, which cuts the lineage; the driver sees two numbers.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = scratch.table(edges.distinct(), f"{name}_0")
    before, number = _state(current), 0
    while True:
        number += 1
        following = scratch.table(_small_star(_large_star(current)), f"{name}_{number}")
        after = _state(following)
        if after == before:
            break
        scratch.drop(f"{name}_{number - 1}")
        current, before = following, after
    roots = following.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return following.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    tied = both.where("b > a").join(least, "a")
    return tied.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges lead from the larger node ``a`` to the smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a")
    moved = tied.where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    kept = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(kept).where("a <> b").distinct()
