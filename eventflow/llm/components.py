"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventflow.llm.common import written


def _smallest(pairs: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours. Combined map-side: a hub costs a row per task."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. The edges shrink to stars around the smallest nodes in a
    logarithmic number of rounds; each round is written to the shared folder, which cuts the lineage.
    Null ends and loops are no edges, repeated edges count once, and no edges give no rows.
    """
    up, down = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = written(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(up, down).distinct(),
        "edges", slim=True,
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        smallest = _smallest(large)
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = smallest.select("u", F.col("m").alias("v"))
        now = written(small.unionByName(star).where("u > v").distinct(), "edges", slim=True)
