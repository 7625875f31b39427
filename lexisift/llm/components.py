"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisift.session import durable


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``(a, b)`` links to ``(id, component)``, the component named by its smallest id.

    Ids without a link are not in the result. Every round hangs larger neighbours on the
    smallest one and writes the edges, so lineage stays short; the number of rounds grows
    with the logarithm of the longest chain. A hub's edges meet only a one-row side in
    each join, which adaptive execution splits. Nulls and self links are ignored.
    """
    current = durable(edges.where("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(smallest, "u").where("v <> m")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        current = durable(small.unionByName(root.withColumnRenamed("m", "lo")).distinct(), "edges")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        current.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
