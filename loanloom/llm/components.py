"""Connected components of an edge table by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.scratch import Scratch

MAX_ROUNDS = 200


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b); a component is named
    by its smallest node. Each step is two aggregations by node and a join with
    their stored result, whose large keys adaptive execution can split; the
    number of rounds grows with the logarithm of the longest path."""
    now = edges.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    now = scratch.store(now.distinct(), f"{name}-0")
    before = _state(now)
    done = before[0] == 0
    for k in range(1, MAX_ROUNDS):
        if done:
            break
        # large star: larger neighbours of a node go to its smallest neighbour
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        least = scratch.store(least, f"{name}-{k}-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.store(large.distinct(), f"{name}-{k}-large")
        # small star: smaller neighbours of a node, and the node, go to the smallest
        # (no node has many smaller neighbours left, so this join has no large keys)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = scratch.store(
            moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{k}"
        )
        scratch.drop(f"{name}-{k - 1}", *(f"{name}-{k}-{s}" for s in ("least", "large")))
        after = _state(now)
        done, before = after == before, after
    if not done:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
